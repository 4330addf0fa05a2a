"""What a path defines, what a file refers to and what a line mentions."""

from pyspark.sql import DataFrame, functions as F

from ..functions import monikers, ranges, roles
from ..graph import SYMBOL_KEY, CodeGraph, file_bucket
from ..plans.rangejoin import LEVELS, add_interval_buckets, add_point_buckets
from ..plans.ranking import top_per_key
from ..plans.sizing import hinted, never_broadcast, profile
from .matching import match_prefix


def _with_name(df):
    return df.withColumn("display_name", monikers.display_name(F.col("symbol")))


def _asked_files(graph, asked):
    """Inputs with the edge partition of their file. No document has an empty path; saying so
    tells the planner that the partitions asked for are worth selecting."""
    return asked.filter(F.length("file") > 0).withColumn("file_bucket", file_bucket(F.col("file"), graph.site_buckets))


def _file_edges(graph):
    return graph.stored_file_sites.withColumnRenamed("relative_path", "file")


def list_symbols(graph: CodeGraph, scopes: DataFrame, limit=None, boundary=False) -> DataFrame:
    """Definition ranges in documents under a path prefix. Empty scopes give nothing."""
    if graph.indexes is not None:
        located = match_prefix(graph.indexes.paths, "relative_path", scopes, boundary=boundary, splits=graph.indexes.path_splits)
    elif graph.stored_definitions is not None:
        located = match_prefix(graph.stored_definitions, "relative_path", scopes, boundary=boundary)
    else:
        documents = graph.documents.select("source", "doc_id", "relative_path")
        inside = match_prefix(documents, "relative_path", scopes, boundary=boundary)
        located = graph.definition_ranges.join(inside, ["source", "doc_id"]).join(
            graph.symbols.select(*SYMBOL_KEY, "symbol"), SYMBOL_KEY,
        )
    located = located.withColumnRenamed("relative_path", "file")
    order = ["file", "start_line", "start_char", "end_line", "end_char", "symbol", "source"]
    capped = top_per_key(located, ["query_id"], [F.col(c) for c in order], limit)
    return _with_name(capped).select(
        "query_id", "scope", "symbol", "display_name", "source", "file", "start_line", "end_line", "start_char",
        "end_char",
    )


def get_imports(graph: CodeGraph, files: DataFrame, limit=None, role_policy="strict") -> DataFrame:
    """Distinct symbols a file mentions without defining them, ordered by moniker."""
    small = hinted(_asked_files(graph, files), profile(files).small)
    keep = lambda role: roles.is_reference_role(role, role_policy)
    if graph.stored_file_sites is not None:
        hits = _file_edges(graph).filter(keep(F.col("role"))).join(small, ["file_bucket", "file"])
        distinct = hits.select("query_id", "file", "symbol").distinct()
    else:
        documents = graph.documents.join(small, F.col("relative_path") == F.col("file"))
        hits = (
            documents.select("query_id", "file", "source", "doc_id")
            .join(graph.chunks.select("source", "doc_id", "chunk_id"), ["source", "doc_id"])
            .join(graph.mentions.filter(keep(F.col("role"))).drop("role"), ["source", "chunk_id"])
            .select("query_id", "file", *SYMBOL_KEY).distinct()
        )
        distinct = hits.join(graph.symbols.select(*SYMBOL_KEY, "symbol"), SYMBOL_KEY).select(
            "query_id", "file", "symbol",
        ).distinct()
    return _with_name(top_per_key(distinct, ["query_id"], [F.col("symbol")], limit))


def symbols_at(graph: CodeGraph, positions: DataFrame, limit=None, measure=True) -> DataFrame:
    """Distinct symbols, in any role, of the chunks that contain a line.

    A chunk lies in one or two buckets of the level that fits its length, a line in one bucket of every level; file,
    level and bucket are the join key. So a file with most of the chunks, or of the positions, is spread, a chunk of a
    million lines is two rows, and no other pairs are formed. A position is a row of every level, so that many times the
    measured positions must fit a broadcast; more of them are shuffled. ``measure=False`` leaves the choice of a broadcast to the
    adaptive planner, for positions that are dear to compute.
    """
    asked = add_point_buckets(_asked_files(graph, positions), F.col("line"))
    if measure:
        small = profile(positions).times(len(LEVELS)).small
        asked = hinted(asked, True) if small else never_broadcast(asked)
    within = ranges.line_in_chunk(F.col("line"), F.col("start_line"), F.col("end_line"))
    if graph.stored_file_sites is not None:
        spans = add_interval_buckets(_file_edges(graph), F.col("start_line"), F.col("end_line"))
        hits = spans.join(asked, ["file_bucket", "file", "_level", "_bucket"]).filter(within)
        distinct = hits.select("query_id", "file", "line", "symbol").distinct()
    else:
        chunks = graph.chunks.select("source", "doc_id", "chunk_id", "start_line", "end_line")
        paths = graph.documents.select("source", "doc_id", F.col("relative_path").alias("file"))
        spans = add_interval_buckets(chunks.join(paths, ["source", "doc_id"]), F.col("start_line"), F.col("end_line"))
        hits = (
            spans.join(asked, ["file", "_level", "_bucket"]).filter(within)
            .select("query_id", "file", "line", "source", "chunk_id")
            .join(graph.mentions.select("source", "chunk_id", *SYMBOL_KEY).distinct(), ["source", "chunk_id"])
            .select("query_id", "file", "line", *SYMBOL_KEY).distinct()
        )
        distinct = hits.join(graph.symbols.select(*SYMBOL_KEY, "symbol"), SYMBOL_KEY).select(
            "query_id", "file", "line", "symbol",
        ).distinct()
    return _with_name(top_per_key(distinct, ["query_id"], [F.col("symbol")], limit))
