"""Queries over the given tables, with the same result in SQL for each."""
