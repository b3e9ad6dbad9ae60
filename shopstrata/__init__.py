"""Layered retail metrics (detail, metric and result tables) as plain Spark DataFrame code."""
