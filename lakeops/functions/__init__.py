"""Column helpers and SQL functions."""
