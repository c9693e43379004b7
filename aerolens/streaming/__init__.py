"""Structured Streaming form of the ingest: new yearly files are scanned,
enriched and appended incrementally, exactly once per file."""

from aerolens.streaming.ingest import enriched_stream, flight_stream, start_ingest

__all__ = ["enriched_stream", "flight_stream", "start_ingest"]
