"""DataFrame-in, DataFrame-out operators over the record log."""
