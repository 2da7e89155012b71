"""Sources and sinks: the year-partitioned Parquet lake and landing files."""
