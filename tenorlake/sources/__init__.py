"""Reading and writing snapshots, documents and configuration."""

from tenorlake.sources import config, documents, lineage, snapshots

__all__ = ["config", "documents", "lineage", "snapshots"]
