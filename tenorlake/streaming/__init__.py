"""Catch-up ingestion of snapshot files as they arrive."""

from tenorlake.streaming import catchup

__all__ = ["catchup"]
