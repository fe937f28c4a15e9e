"""Frame-level operators: joins, aggregates, ordering, set changes, text mining and modelling."""
