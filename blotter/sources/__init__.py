"""Sources and sinks: parquet readers, CSV landing, fixtures."""
