"""Registered views (catalog), their DuckDB oracle SQL, and the per-application context
that materialises the shared row fact."""
