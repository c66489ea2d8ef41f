"""Star-schema analytics and date-partitioned ingest, written for Spark."""
