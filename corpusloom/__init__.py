"""Content-corpus engine: web and PDF text to a clean, queryable table, on Spark."""
