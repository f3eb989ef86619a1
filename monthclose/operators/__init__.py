"""Table maintenance, comparison, checks and reports."""
