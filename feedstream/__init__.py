"""Feed analytics on Spark: ingest, clean, classify and summarise news and social articles."""
