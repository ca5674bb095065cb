"""Table sources and sinks: JDBC, parquet, in-memory frames; run log."""
