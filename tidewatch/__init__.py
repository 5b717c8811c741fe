"""Panel analytics on Spark: one row per entity and day, plain DataFrame code."""
