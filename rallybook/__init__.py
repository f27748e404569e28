"""Contest analytics on Spark: raw CSV to bronze, silver and gold tables."""
