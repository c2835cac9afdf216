"""Incremental ingest of landed pages with Structured Streaming."""
from finmesh.streaming.landing import ingest_pages, page_records  # noqa: F401
