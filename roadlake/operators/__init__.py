"""DataFrame operators: filters, joins, aggregates, windows, as-of search, metrics, ML."""
