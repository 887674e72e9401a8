"""Access-log monitoring on Spark: parsing, error-rate alerts, error windows,
reports and topic-throughput queries, shared by batch and streaming jobs."""
