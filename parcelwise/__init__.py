"""Shipment analytics on Spark: ingestion, cleaning, KPIs, reports, sinks, checks, streams."""

__version__ = "0.1.0"
