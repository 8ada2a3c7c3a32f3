"""Queries over the test tables, one for each operator, with the SQL they are checked against."""
