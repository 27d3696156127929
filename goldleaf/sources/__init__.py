"""Sources and sinks: raw CSV extracts, partitioned Parquet tables, staging, test fixtures."""
