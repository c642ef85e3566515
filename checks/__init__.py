"""Queries over the test tables and the SQL their results are compared with."""
