"""DataFrame operators: panel windows, joins, aggregates, reshaping, dedupe, reports."""
