"""Inputs derived from the given tables, registered queries and the SQL they are checked against."""
