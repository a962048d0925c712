"""DataFrame operators: joins, aggregates, ordered operators, set operations."""
