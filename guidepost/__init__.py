"""Metadata-driven ingestion on Spark: what to read, how to name and clean it, what to check."""

from guidepost.control import ControlTables

__all__ = ["ControlTables"]
