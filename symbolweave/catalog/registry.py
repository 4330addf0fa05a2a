"""Collects the named queries of the catalog modules."""

QUERIES = {}
ORACLES = {}


def register(name, sql=None):
    """Register a ``(spark, folder) -> DataFrame`` function, with its SQL if it has one."""
    def keep(function):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return keep


from . import expressions, files, ingest, lookups, merging, sources, stored  # noqa: E402,F401
