"""The user-facing queries, composed from the operators."""
