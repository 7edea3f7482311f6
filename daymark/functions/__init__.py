"""Column expressions: no data access, no actions."""
