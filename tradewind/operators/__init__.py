"""DataFrame-to-DataFrame operators: change feed, dimensions, widening, metrics, patterns."""
