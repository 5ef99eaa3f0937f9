"""Column-level helpers: SQL types, dates and load intervals."""
