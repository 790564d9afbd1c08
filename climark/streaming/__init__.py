"""Structured Streaming ingestion and forecast-on-arrival."""

from climark.streaming.ingest import stream_daily_forecast, stream_ingest_observations  # noqa: F401
