"""DuckDB statements that compute the registered queries independently from the raw tables."""
