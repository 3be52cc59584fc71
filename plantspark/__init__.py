"""Plant telemetry analytics on Spark: ingestion, rules, series operators, reports, quality, rollups."""
