"""Readers: files, lines, encodings, layouts and database queries."""
