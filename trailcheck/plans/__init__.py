"""Query registry (one callable per operator), DuckDB oracles and the full audit plan."""
