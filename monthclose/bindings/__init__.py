"""Queries over the given tables, one per operator, with the SQL that must give the same rows."""
