"""Named queries (Spark plans + their DuckDB oracle SQL) and workflows."""
