"""DuckDB statements that state each registered query a second time, independently."""
