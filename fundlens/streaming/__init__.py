"""Structured Streaming entry points.

The reference has no streaming operators; this package only runs the batch
ingestion (validate -> region enrich -> country-partitioned Parquet) over
files as they land, with the same operators as the batch path.
"""

from .ingest import ingest_stream  # noqa: F401
