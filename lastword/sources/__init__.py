"""Feed and table sources, and the sinks that write them."""
