"""Column expressions: no Python worker runs for any of them."""
