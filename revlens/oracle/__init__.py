"""DuckDB twins of the Spark queries (the correctness oracle)."""
