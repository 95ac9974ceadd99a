"""DataFrame operators: conforming raw rows, and the per-incident aggregates."""
