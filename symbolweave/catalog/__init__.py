"""Named queries over the star-schema tables, each with the SQL that states its result."""

from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
