"""Definitions, references and implementations for a whole set of names at once."""

from pyspark.sql import DataFrame, Window, functions as F

from ..constants import MAX_RESULTS
from ..functions import monikers, ranges, roles
from ..graph import SYMBOL_KEY, CodeGraph
from ..plans.ranking import top_per_key
from ..plans.sizing import BROADCAST_ROWS, hinted
from ..sources.indexes import bucket_of, target_key
from .matching import match_indexed, match_names, match_substring

MATCH_KEYS = ["query_id", *SYMBOL_KEY, "is_exact", "length_rank"]
LOCATION = ["file", "start_line", "end_line", "start_char", "end_char"]


def _match(graph, queries, match, cap, exact_first):
    """Matched symbol rows and the measured number of queries."""
    if match == "exact":
        pairs, asked = match_names(graph, queries)
    elif graph.indexes is not None:
        pairs, asked = match_indexed(graph, queries, match=match)
    else:
        pairs, asked = match_substring(graph.symbols.select(*SYMBOL_KEY, "symbol"), "symbol", queries, match=match)
    shown = monikers.display_name(F.col("symbol"))
    exact = shown == F.col("name")
    by_length = [F.length("symbol"), F.col("symbol")]
    if cap is None:
        ranked = pairs.withColumn("length_rank", F.length("symbol"))
    else:
        order = [exact.desc(), *by_length] if exact_first else by_length
        ranked = top_per_key(pairs, ["query_id"], order, cap, rank="dense_rank", column="length_rank")
    return ranked.withColumns({"display_name": shown, "is_exact": exact}), asked.rows


def matched_symbols(graph: CodeGraph, queries: DataFrame, match="like", cap=None, exact_first=False):
    """Symbol rows per query, all of them unless a cap of distinct monikers, shortest first, is given.

    ``match`` is ``like`` (``%`` and ``_`` are wildcards), ``literal`` or ``exact`` (the display name as it is).
    The cap is applied before exact names are moved to the front, so an exact
    name can fall outside it; ``exact_first`` ranks exact names before the cap.
    """
    return _match(graph, queries, match, cap, exact_first)[0]


def resolve_symbols(graph: CodeGraph, queries: DataFrame, match="like", cap=None, exact_first=False):
    """Candidate monikers per name: exact display names first, then by length."""
    found = matched_symbols(graph, queries, match, cap, exact_first)
    distinct = found if graph.merged else found.dropDuplicates(["query_id", "symbol"])
    columns = ["query_id", "name", "symbol", "display_name", "is_exact"]
    if cap is None:
        return distinct.select(*columns)
    window = Window.partitionBy("query_id").orderBy(F.col("is_exact").desc(), "length_rank")
    return distinct.select(*columns, F.dense_rank().over(window).alias("rank"))


def resolve_exact(graph: CodeGraph, names) -> DataFrame:
    """Symbols with one of a few given display names, as a plain filter of the stored names.

    The names are literals, so partitions are left out when the query is planned and row groups by their bloom filters.
    """
    if graph.indexes is None:
        return graph.named_symbols().filter(F.col("display_name").isin(list(names)))
    buckets = [bucket_of(F.lit(n), graph.indexes.buckets) for n in names]
    found = graph.indexes.names.filter(F.col("name_bucket").isin(buckets) & F.col("display_name").isin(list(names)))
    return found.select(*SYMBOL_KEY, "symbol", "display_name")


def _match_keys(graph, matched, n_queries, cap, extra=()):
    """Keys of the matched symbols, broadcast when their number is bounded and small.

    In a merged graph a query holds at most ``cap`` keys, and the queries are counted, so
    the bound is known before the job runs.
    """
    bounded = graph.merged and cap is not None and n_queries * cap <= BROADCAST_ROWS
    return hinted(matched.select(*MATCH_KEYS, *extra), bounded)


def _with_symbols(located, matched, limit, order):
    """Cap the located rows per query, then attach moniker and display name."""
    capped = top_per_key(located, ["query_id"], order, limit)
    names = matched.select(*MATCH_KEYS, "name", "symbol", "display_name")
    return capped.join(names, MATCH_KEYS)


def _result_order():
    return [
        F.col("is_exact").desc(), F.col("length_rank"), F.col("relative_path"), F.col("start_line"),
        F.col("start_char"), F.col("end_line"), F.col("end_char"), F.col("source"), F.col("symbol_source"),
        F.col("symbol_id"),
    ]


def _finish(df, extra=()):
    return df.select(
        "query_id", "name", "symbol", "display_name", "source", F.col("relative_path").alias("file"),
        "start_line", "end_line", "start_char", "end_char", *extra,
    )



def _chunk_locations(df):
    return df.withColumn("start_char", F.lit(None).cast("int")).withColumn("end_char", F.lit(None).cast("int"))


def find_definitions(
    graph: CodeGraph, queries: DataFrame, limit=None, match="like", cap=None, exact_first=False,
    bitwise=False,
) -> DataFrame:
    """Definition sites: precise ranges, or defining chunks for monikers without any range."""
    matched, n_queries = _match(graph, queries, match, cap, exact_first)
    # Without a cap the rank is the moniker's length; beside sources that are not merged its hash tells monikers apart.
    moniker = [] if cap is not None or graph.merged else [F.xxhash64("symbol").alias("_moniker")]
    keys = _match_keys(graph, matched, n_queries, cap, moniker)
    precise = graph.range_sites(keys)
    fallback = _chunk_locations(graph.mention_sites(keys, lambda role: roles.is_definition_role(role, bitwise)))
    columns = [*MATCH_KEYS, *(["_moniker"] if moniker else []), "source", "relative_path", "start_line", "end_line", "start_char", "end_char"]
    both = precise.select(*columns, F.lit(True).alias("precise")).unionByName(
        fallback.select(*columns, F.lit(False).alias("precise")),
    )
    # A moniker with a precise range takes no fallback rows. With a limit each branch is cut
    # first - rows of one moniker past the limit can never be returned - and what is left
    # per moniker is small enough for a window; without one an anti join keeps both whole.
    per_symbol = ["query_id", "length_rank"] if cap is not None else ["query_id", *SYMBOL_KEY] if graph.merged else ["query_id", "_moniker"]
    if limit is None:
        ranged = precise.select(*per_symbol).distinct()
        kept = precise.select(*columns).unionByName(fallback.join(ranged, per_symbol, "left_anti").select(*columns))
    else:
        cut = top_per_key(both, [*per_symbol, "precise"], _result_order(), limit)
        any_precise = F.max("precise").over(Window.partitionBy(*per_symbol))
        kept = cut.withColumn("_any", any_precise).filter(F.col("precise") == F.col("_any")).select(*columns)
    return _finish(_with_symbols(kept, matched, limit, _result_order()))


def find_references(
    graph: CodeGraph, queries: DataFrame, limit=None, include_definition=False, match="like",
    cap=None, exact_first=False, role_policy="strict",
) -> DataFrame:
    """Chunks that mention a matched symbol without defining it; optionally definitions too."""
    matched, n_queries = _match(graph, queries, match, cap, exact_first)
    keys = _match_keys(graph, matched, n_queries, cap)
    wanted = roles.is_mention_role if include_definition else roles.is_reference_role
    located = _chunk_locations(graph.mention_sites(keys, lambda role: wanted(role, role_policy)))
    order = [*_result_order(), F.col("role")]
    return _finish(_with_symbols(located, matched, limit, order), extra=["role", "is_exact", "length_rank"])


def find_implementations(
    graph: CodeGraph, queries: DataFrame, limit=None, match="like", cap=None, exact_first=False,
    by_key=False, fallback=False,
) -> DataFrame:
    """Symbols that declare an implementation of a matched symbol, one site each.

    Targets are compared as raw monikers; ``by_key`` ignores package and version. A symbol
    without a precise range is left out unless ``fallback`` allows its defining chunk.
    """
    asked = queries.filter(F.col("name") != "")
    matched, n_queries = _match(graph, asked, match, cap, exact_first)
    bounded = graph.merged and cap is not None and n_queries * cap <= BROADCAST_ROWS
    # What has one raw moniker has one key, so the key leads to the stored relationships in both cases.
    target = [] if by_key else ["target"]
    targets = matched.select(
        "query_id", "name", F.col("symbol").alias("target"), target_key(F.col("symbol")).alias("target_key"),
    ).select("query_id", "name", "target_key", *target).distinct()
    keys = ["target_key", *target]
    if graph.indexes is not None:
        targets = targets.withColumn("target_bucket", bucket_of(F.col("target_key"), graph.indexes.buckets))
        edges, keys = graph.indexes.targets, ["target_bucket", *keys]
    else:
        edges = graph.relationships().withColumn("target_key", target_key(F.col("target")))
    edges = edges.filter("is_implementation").select(*SYMBOL_KEY, "symbol", *keys)
    implementors = edges.join(hinted(targets, bounded), keys).dropDuplicates(["query_id", *SYMBOL_KEY])

    # First site per symbol is found once per symbol, whatever number of queries asks for it.
    asked_keys = implementors.select(*SYMBOL_KEY).distinct()
    site = F.struct("relative_path", "start_line", "start_char", "end_line", "end_char", "source")
    first = graph.range_sites(asked_keys).groupBy(*SYMBOL_KEY).agg(F.min(site).alias("site"))
    if fallback:
        chunks = _chunk_locations(graph.mention_sites(asked_keys, roles.is_definition_role))
        spare = chunks.groupBy(*SYMBOL_KEY).agg(F.min(site).alias("site"))
        first = first.unionByName(spare.join(first, SYMBOL_KEY, "left_anti"))
    located = implementors.join(first, SYMBOL_KEY).select(
        "query_id", "name", "symbol", monikers.display_name(F.col("symbol")).alias("display_name"), "site.*",
        *SYMBOL_KEY,
    )
    order = [F.col(c) for c in SYMBOL_KEY]
    return _finish(top_per_key(located, ["query_id"], order, limit))


def render(results: DataFrame) -> DataFrame:
    """Add the short text form of each location."""
    return results.withColumn(
        "location",
        ranges.render_location(F.col("file"), F.col("start_line"), F.col("end_line"), F.col("start_char")),
    )


def unmatched(queries: DataFrame, results: DataFrame) -> DataFrame:
    """Queries without any result."""
    return queries.join(results.select("query_id").distinct(), "query_id", "left_anti")


def with_cap_flag(results: DataFrame, cap=MAX_RESULTS) -> DataFrame:
    """Mark the results of queries that reached their cap.

    Counts are aggregated map-side and joined back, so a large query is not gathered.
    """
    counts = results.groupBy("query_id").agg((F.count(F.lit(1)) >= cap).alias("capped"))
    return results.join(counts, "query_id")
