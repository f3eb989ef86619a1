"""Monthly-close pipelines on Spark: scan extracts, load months, build, check and report."""
