"""Commerce analytics on Spark: ingest, staging, marts, quality and dashboards as DataFrame jobs."""
