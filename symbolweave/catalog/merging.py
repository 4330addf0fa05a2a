"""Merge of many sources, at once, step by step and with a corpus."""

from pyspark.sql import functions as F

from ..operators import merge
from . import sql
from .inputs import raw_graph
from .registry import register


def _source(graph, condition):
    """The part of a raw graph whose source meets a condition."""
    keep = lambda df, name: df.filter(condition(F.col(name)))
    return graph.with_tables(
        documents=keep(graph.documents, "source"), symbols=keep(graph.symbols, "symbol_source"),
        chunks=keep(graph.chunks, "source"), mentions=keep(graph.mentions, "source"),
        definition_ranges=keep(graph.definition_ranges, "source"),
    )


_SYMBOLS = f"{sql.MERGED} SELECT symbol_source, symbol_id, symbol FROM msym"


@register("merge_symbols", _SYMBOLS)
def _(spark, folder):
    return merge.merge_sources(raw_graph(spark, folder)).symbols.select("symbol_source", "symbol_id", "symbol")


@register("merge_mentions", f"{sql.MERGED} SELECT source, chunk_id, symbol_source, symbol_id, role FROM mment")
def _(spark, folder):
    return merge.merge_sources(raw_graph(spark, folder)).mentions


@register("merge_ranges", f"""{sql.MERGED}
SELECT source, symbol_source, symbol_id, doc_id, start_line, start_char, end_line, end_char FROM mrange""")
def _(spark, folder):
    return merge.merge_sources(raw_graph(spark, folder)).definition_ranges


@register("merge_documents", f"{sql.MERGED} SELECT source, doc_id, relative_path, language FROM mdocs")
def _(spark, folder):
    merged = merge.merge_sources(raw_graph(spark, folder))
    return merged.documents.select("source", "doc_id", "relative_path", "language")


@register("symbol_map", f"{sql.MERGED} SELECT source AS symbol_source, symbol_id, csource AS canonical_source, cid AS canonical_id FROM smap")
def _(spark, folder):
    graph = raw_graph(spark, folder)
    keyed = merge.keyed_symbols(graph.symbols.withColumns(
        {"_label": F.col("symbol_source"), "_position": F.col("symbol_source")},
    ))
    return merge.symbol_map(keyed, merge.canonical_symbols(keyed))


@register("merge_incremental_symbols", _SYMBOLS)
def _(spark, folder):
    graph = raw_graph(spark, folder)
    merged = merge.merge_sources(_source(graph, lambda s: s < "repo-4"))
    grown = merge.extend_graph(merged, "repo-4", _source(graph, lambda s: s == "repo-4"))
    return grown.symbols.select("symbol_source", "symbol_id", "symbol")


@register("merge_incremental_mentions", f"{sql.MERGED} SELECT source, chunk_id, symbol_source, symbol_id, role FROM mment")
def _(spark, folder):
    graph = raw_graph(spark, folder)
    merged = merge.merge_sources(_source(graph, lambda s: s < "repo-4"))
    return merge.extend_graph(merged, "repo-4", _source(graph, lambda s: s == "repo-4")).mentions


_LABELLED = f"""{sql.RAW}, keyed AS (SELECT *, {sql.KEY.format('symbol', 'source')} AS nkey,
  CASE source WHEN 'repo-3' THEN 0 WHEN 'repo-1' THEN 1 END AS pos FROM symbols WHERE source IN ('repo-1', 'repo-3')),
canon AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY nkey ORDER BY pos, symbol_id) AS rn FROM keyed) WHERE rn = 1)"""


@register("merge_labelled_sources", f"""{_LABELLED}
SELECT source AS symbol_source, symbol_id, CASE WHEN symbol LIKE 'local%' THEN source || '/' || symbol ELSE symbol END AS symbol
FROM canon""")
def _(spark, folder):
    graph = raw_graph(spark, folder)
    pick = lambda name: _source(graph, lambda s: s == name)
    merged = merge.merge_graphs([("repo-3", pick("repo-3")), ("repo-1", pick("repo-1"))])
    return merged.symbols.select("symbol_source", "symbol_id", "symbol")


_CORPUS = f"""{sql.RAW}, session AS (SELECT source, symbol_id, symbol FROM symbols WHERE source = 'repo-0'),
ckey AS (SELECT *, {sql.KEY.format('symbol', 'source')} AS nkey FROM symbols WHERE source <> 'repo-0'),
corpus AS (SELECT source, symbol_id, CASE WHEN symbol LIKE 'local%' THEN source || '/' || symbol ELSE symbol END AS symbol
  FROM (SELECT *, row_number() OVER (PARTITION BY nkey ORDER BY source, symbol_id) AS rn FROM ckey) WHERE rn = 1),
mixed AS (
  SELECT 0 AS pos, '' AS label, source AS symbol_source, symbol_id, symbol FROM session
  UNION ALL SELECT 1, 'corpus', 'corpus/' || source, symbol_id, symbol FROM corpus),
bkey AS (SELECT *, {sql.KEY.format('symbol', 'label')} AS nkey FROM mixed)
SELECT symbol_source, symbol_id,
  CASE WHEN symbol LIKE 'scip-go gomod %' THEN symbol ELSE label || '/' || symbol END AS symbol
FROM (SELECT *, row_number() OVER (PARTITION BY nkey ORDER BY pos, symbol_source, symbol_id) AS rn FROM bkey) WHERE rn = 1"""


def _with_corpus(spark, folder):
    graph = raw_graph(spark, folder)
    corpus = merge.merge_sources(_source(graph, lambda s: s != "repo-0"))
    return merge.union_with_corpus(_source(graph, lambda s: s == "repo-0"), corpus)


@register("corpus_union_symbols", _CORPUS)
def _(spark, folder):
    return _with_corpus(spark, folder).symbols.select("symbol_source", "symbol_id", "symbol")


@register("corpus_union_documents", f"""{sql.RAW} SELECT
  CASE WHEN source = 'repo-0' THEN source ELSE 'corpus/' || source END AS source, doc_id,
  CASE WHEN source = 'repo-0' THEN relative_path ELSE 'corpus/' || source || '/' || relative_path END AS relative_path
FROM docs""")
def _(spark, folder):
    return _with_corpus(spark, folder).documents.select("source", "doc_id", "relative_path")


@register("id_offsets", f"""{sql.RAW}, tops AS (
  SELECT source, dense_rank() OVER (ORDER BY source) AS position,
    (SELECT max(doc_id) FROM docs d WHERE d.source = s.source) AS md,
    (SELECT max(chunk_id) FROM chunks c WHERE c.source = s.source) AS mc
  FROM (SELECT DISTINCT source FROM docs) s)
SELECT source, CAST(coalesce(sum(md) OVER w, 0) AS BIGINT) AS doc_offset, CAST(coalesce(sum(mc) OVER w, 0) AS BIGINT) AS chunk_offset
FROM tops WINDOW w AS (ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def _(spark, folder):
    graph = raw_graph(spark, folder)
    # One row per source: the list of sources is small and is ordered by name.
    positions = graph.documents.select("source").distinct().withColumn("position", F.col("source"))
    return merge.id_offsets(graph.documents, graph.chunks, positions).drop("position")


@register("null_moniker_counts", f"""{sql.RAW}
SELECT source AS symbol_source, count(*) FILTER (WHERE symbol LIKE 'local%') AS null_monikers FROM symbols GROUP BY source""")
def _(spark, folder):
    symbols = raw_graph(spark, folder).symbols
    lost = symbols.withColumn("symbol", F.when(~F.startswith("symbol", F.lit("local")), F.col("symbol")))
    return merge.null_moniker_count(lost)
