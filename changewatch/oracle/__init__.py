"""The same results as SQL, written for DuckDB, to check every report against."""
