"""Scans, fixtures built from the driver's tables, and sinks."""

from panelforge.sources.tables import read_table
from panelforge.sources.panels import panel_dense, panel_sparse, raw_drops

__all__ = ["read_table", "panel_dense", "panel_sparse", "raw_drops"]
