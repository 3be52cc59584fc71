"""DataFrame operators: normalising, alerts, series, neighbours, quality, rollups."""
