"""Symbol-graph analytics as ordinary Spark DataFrame jobs."""

from .graph import CodeGraph

__all__ = ["CodeGraph"]
