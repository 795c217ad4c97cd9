"""Network telemetry analytics on Spark: ingestion, reports, checks, maintenance."""
