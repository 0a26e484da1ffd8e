"""Sales and refund settlement on Spark: windows, sources, report, loads, checks."""
