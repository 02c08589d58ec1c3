"""Station-data operators and jobs for Spark: clean, feature, join, score, monitor."""
