"""The driver's test tables mapped onto the road-speed domain, one query per operator, and its DuckDB statement."""
