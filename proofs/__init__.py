"""Queries over the test tables, each with an equivalent SQL statement."""
