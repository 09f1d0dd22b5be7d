"""Queries over the test tables, and the same results stated in SQL."""
