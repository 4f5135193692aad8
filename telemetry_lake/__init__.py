"""Telemetry lake: land JSON-lines reports, keep them as Parquet, report on them."""
