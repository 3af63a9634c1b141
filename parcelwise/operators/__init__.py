"""DataFrame -> DataFrame operators: ingestion, cleaning, KPIs, reports, dedup, sample."""

from parcelwise.operators import clean, dedup, ingest, kpis, reports, sample  # noqa: F401
