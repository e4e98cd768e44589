"""Credit-risk features, labels, scores and monitoring as Spark DataFrame operators."""

from tenorlake.settings import prepare

__all__ = ["prepare"]
