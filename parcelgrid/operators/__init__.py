"""DataFrame builders: spatial joins, tiles, aggregates and result checks."""
