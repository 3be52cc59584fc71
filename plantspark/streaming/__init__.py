"""Structured Streaming jobs: ingestion, alerts, windows, and series operators over closed time ranges."""
