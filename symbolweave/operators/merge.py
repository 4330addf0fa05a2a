"""Union of many sources into one graph in which a shared symbol is one row."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import monikers, paths
from ..graph import SYMBOL_KEY, CodeGraph
from ..plans.sizing import never_broadcast

_TABLES = ("documents", "symbols", "chunks", "mentions", "definition_ranges")


def _relabel(graph: CodeGraph, label: str, position: int) -> CodeGraph:
    """Give every id of a graph the scope of its label and remember label and position.

    A graph that already holds several sources keeps them apart as ``label/source``.
    """
    def scoped(df, *columns):
        for name in columns:
            own = F.coalesce(F.col(name), F.lit(""))
            joined = F.when(own == "", label).when(own == label, own).otherwise(F.concat_ws("/", F.lit(label), own))
            df = df.withColumn(name, joined if label else own)
        return df

    if label:
        clash = graph.documents.filter(F.coalesce("source", F.lit("")).isin("", label)).select(F.coalesce("source", F.lit(""))).distinct()
        if clash.count() > 1:
            raise ValueError(f"the graph labelled {label!r} holds both an unnamed source and one of that name")
    marks = {"_label": F.lit(label), "_position": F.lit(position)}
    return CodeGraph(
        documents=scoped(graph.documents, "source").withColumns(marks),
        symbols=scoped(graph.symbols, "symbol_source").withColumns(marks),
        chunks=scoped(graph.chunks, "source"),
        mentions=scoped(graph.mentions, "source", "symbol_source"),
        definition_ranges=scoped(graph.definition_ranges, "source", "symbol_source"),
    )


def _union(frames):
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_graphs(sources) -> CodeGraph:
    """Merge ``[(label, graph), ...]``; the first source that holds a symbol describes it.

    Paths are prefixed with the label and symbols are unified by their version-free key.
    One source alone passes through unchanged; no source is an error.
    """
    sources = list(sources)
    if not sources:
        raise ValueError("no source graphs to merge")
    if len(sources) == 1:
        return sources[0][1]
    labelled = [_relabel(graph, label, position) for position, (label, graph) in enumerate(sources)]
    together = CodeGraph(**{name: _union([getattr(g, name) for g in labelled]) for name in _TABLES})
    return _unify(together)


def merge_sources(graph: CodeGraph, position: Column | None = None) -> CodeGraph:
    """Merge a table set whose ``source`` column already tells the sources apart.

    This is the form for large corpora: the plan does not grow with the number of sources.
    ``position`` orders the sources (default: by name).
    """
    own = lambda name: {"_label": F.col(name), "_position": position if position is not None else F.col(name)}
    return _unify(graph.with_tables(
        documents=graph.documents.withColumns(own("source")),
        symbols=graph.symbols.withColumns(own("symbol_source")),
    ))


def merge_labelled(graph: CodeGraph) -> CodeGraph:
    """Merge tables that carry the ``_label`` and ``_position`` of the source graph of each row.

    Ids get the scope of their label as in ``merge_graphs``, by expressions, so the plan does not grow with the sources.
    """
    def scoped(df, *columns):
        for name in columns:
            own = F.coalesce(F.col(name), F.lit(""))
            joined = F.when(own == "", F.col("_label")).when(own == F.col("_label"), own)
            df = df.withColumn(name, F.when(F.col("_label") == "", own).otherwise(joined.otherwise(F.concat_ws("/", "_label", own))))
        return df

    plain = F.coalesce("source", F.lit(""))
    both = graph.documents.filter("_label <> ''").groupBy("_label").agg(
        F.max(plain == "").alias("unnamed"), F.max(plain == F.col("_label")).alias("named"),
    ).filter("unnamed AND named").select("_label").take(1)
    if both:
        raise ValueError(f"the graph labelled {both[0][0]!r} holds both an unnamed source and one of that name")
    return _unify(CodeGraph(
        documents=scoped(graph.documents, "source"), symbols=scoped(graph.symbols, "symbol_source"),
        chunks=scoped(graph.chunks, "source").drop("_label", "_position"),
        mentions=scoped(graph.mentions, "source", "symbol_source").drop("_label", "_position"),
        definition_ranges=scoped(graph.definition_ranges, "source", "symbol_source").drop("_label", "_position"),
    ))


def keyed_symbols(symbols: DataFrame) -> DataFrame:
    """Symbols with their identity key. Null monikers cannot be unified and are left out."""
    return symbols.filter(F.col("symbol").isNotNull()).withColumn(
        "symbol_key", monikers.dedup_key(F.col("symbol"), F.col("_label")),
    )


def null_moniker_count(symbols: DataFrame) -> DataFrame:
    return symbols.groupBy("symbol_source").agg(F.count_if(F.col("symbol").isNull()).alias("null_monikers"))


def canonical_symbols(keyed: DataFrame) -> DataFrame:
    """First holder of each key. The minimum is combined map-side, so a key held by most
    sources is reduced before it is shuffled."""
    holder = F.struct("_position", *SYMBOL_KEY)
    first = keyed.groupBy("symbol_key").agg(F.min(holder).alias("first"))
    return first.select(
        "symbol_key", F.col("first.symbol_source").alias("canonical_source"),
        F.col("first.symbol_id").alias("canonical_id"),
    )


def symbol_map(keyed: DataFrame, canonical: DataFrame) -> DataFrame:
    """Every symbol of every source -> its canonical symbol."""
    return keyed.select(*SYMBOL_KEY, "symbol_key").join(canonical, "symbol_key").drop("symbol_key")


def _remap(edges, mapping):
    """Point edges at canonical symbols. Symbols that are their own canonical row are joined
    too, so an edge of an unknown symbol is dropped as in an inner join."""
    return edges.join(never_broadcast(mapping), SYMBOL_KEY).drop(*SYMBOL_KEY).withColumnsRenamed(
        {"canonical_source": "symbol_source", "canonical_id": "symbol_id"},
    )


def _unify(graph: CodeGraph) -> CodeGraph:
    keyed = keyed_symbols(graph.symbols)
    canonical = canonical_symbols(keyed)
    mapping = symbol_map(keyed, canonical)
    own_row = [
        F.col("symbol_source") == F.col("canonical_source"), F.col("symbol_id") == F.col("canonical_id"),
    ]
    symbols = (
        keyed.join(canonical, "symbol_key").filter(own_row[0] & own_row[1])
        .withColumn("symbol", monikers.storable_symbol(F.col("symbol"), F.col("_label")))
        .drop("symbol_key", "_label", "_position", "canonical_source", "canonical_id")
    )
    documents = graph.documents.withColumn(
        "relative_path", paths.prefix_path(F.col("_label"), F.col("relative_path")),
    ).drop("_label", "_position")
    mention_columns = graph.mentions.columns
    mentions = _remap(graph.mentions, mapping).select(*mention_columns).dropDuplicates(
        ["source", "chunk_id", *SYMBOL_KEY, "role"],
    )
    range_columns = graph.definition_ranges.columns
    return CodeGraph(
        documents=documents,
        symbols=symbols,
        chunks=graph.chunks,
        mentions=mentions,
        definition_ranges=_remap(graph.definition_ranges, mapping).select(*range_columns),
        merged=True,
    )


def extend_graph(merged: CodeGraph, label: str, addition: CodeGraph) -> CodeGraph:
    """Add one source to a merged graph without rewriting what is there.

    Only symbols whose key is new are appended; edges of the addition are mapped to the
    existing or new rows. Documents, chunks and edges of the merged graph pass unchanged.
    """
    known_source = (F.col("source") == label) | F.col("source").startswith(f"{label}/")
    if not merged.documents.filter(known_source).isEmpty():
        raise ValueError(f"the graph already holds a source {label!r}")
    added = _relabel(addition, label, 1)
    old_keys = monikers.dedup_key(F.col("symbol"), F.lit(""))
    known = merged.symbols.select(
        old_keys.alias("symbol_key"), F.col("symbol_source").alias("canonical_source"),
        F.col("symbol_id").alias("canonical_id"),
    )
    keyed = keyed_symbols(added.symbols)
    fresh = canonical_symbols(keyed).join(known, "symbol_key", "left_anti")
    canonical = known.join(keyed.select("symbol_key").distinct(), "symbol_key", "left_semi").unionByName(fresh)
    mapping = symbol_map(keyed, canonical)
    new_rows = keyed.join(
        fresh.select(F.col("canonical_source").alias("symbol_source"), F.col("canonical_id").alias("symbol_id")),
        SYMBOL_KEY, "left_semi",
    ).withColumn("symbol", monikers.storable_symbol(F.col("symbol"), F.col("_label"))).select(*merged.symbols.columns)
    documents = added.documents.withColumn(
        "relative_path", paths.prefix_path(F.col("_label"), F.col("relative_path")),
    ).select(*merged.documents.columns)
    mentions = _remap(added.mentions, mapping).select(*merged.mentions.columns).dropDuplicates(
        ["source", "chunk_id", *SYMBOL_KEY, "role"],
    )
    return CodeGraph(
        documents=merged.documents.unionByName(documents),
        symbols=merged.symbols.unionByName(new_rows),
        chunks=merged.chunks.unionByName(added.chunks.select(*merged.chunks.columns)),
        mentions=merged.mentions.unionByName(mentions),
        definition_ranges=merged.definition_ranges.unionByName(
            _remap(added.definition_ranges, mapping).select(*merged.definition_ranges.columns),
        ),
        merged=True,
    )


def union_with_corpus(session: CodeGraph, corpus: CodeGraph | None) -> CodeGraph:
    """Session graph with bare paths plus a corpus graph under ``corpus/``."""
    return session if corpus is None else merge_graphs([("", session), ("corpus", corpus)])


def id_offsets(documents: DataFrame, chunks: DataFrame, positions: DataFrame) -> DataFrame:
    """Offsets that turn per-source ids into one id range, if plain integers are wanted.

    ``positions`` holds one row per source; the running sum covers those few rows only.
    """
    from pyspark.sql import Window

    top = lambda df, name: df.groupBy("source").agg(F.max(name).alias(f"max_{name}"))
    before = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    maxima = positions.join(top(documents, "doc_id"), "source", "left").join(top(chunks, "chunk_id"), "source", "left")
    filled = lambda name: F.coalesce(F.col(f"max_{name}"), F.lit(0))
    return maxima.select(
        "source", "position",
        F.coalesce(F.sum(filled("doc_id")).over(before), F.lit(0)).alias("doc_offset"),
        F.coalesce(F.sum(filled("chunk_id")).over(before), F.lit(0)).alias("chunk_offset"),
    )
