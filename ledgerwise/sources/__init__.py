"""Sources and sinks: NDJSON ingest, test-table feeds, Parquet tables."""
