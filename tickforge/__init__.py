"""Market price analytics on Spark: landing, change detection, daily bars, currency comparison, anomalies and quality gates."""
