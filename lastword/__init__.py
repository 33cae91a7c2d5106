"""Record-state analytics on Spark: the newest revision of every record wins."""
