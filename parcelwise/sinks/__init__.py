"""Sinks: Parquet/CSV/text outputs, partitioned landing, catalog DDL and publish."""

from parcelwise.sinks import ddl, writers  # noqa: F401
