"""Query registry: key -> Spark plan builder, plus DuckDB oracle SQL."""
