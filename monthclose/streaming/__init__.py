"""Extracts loaded as they arrive."""
