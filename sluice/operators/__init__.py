"""DataFrame-level operators: joins, aggregates, ranking and rule packs."""
