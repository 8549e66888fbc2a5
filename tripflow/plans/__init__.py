"""Composed queries over the test tables, with the SQL that states the same result."""
