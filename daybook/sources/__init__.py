"""Scans: text files, date slices of lake tables, database queries, masters."""
