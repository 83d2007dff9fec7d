"""Structured Streaming ingestion of landed panel drops (G1)."""

from panelforge.streaming.ingest import current_panel, ingest_drops

__all__ = ["current_panel", "ingest_drops"]
