"""Trip analytics on Spark: monthly ingest, staging, star schema, checks and marts."""
