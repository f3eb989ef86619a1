"""Monthly jobs: extract layouts, the tables they build, their checks and their reports."""
