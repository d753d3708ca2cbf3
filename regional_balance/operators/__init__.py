"""DataFrame operators: aggregation, join, rank, validation, spatial assignment."""
