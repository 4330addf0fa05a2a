"""Graphs on disk: grown source by source, opened from many folders, and asked through their stored indexes and by SQL."""

from pyspark.sql import functions as F

from ..functions.sql import register_graph_functions
from ..operators import lookup
from ..sources import segments
from ..sources.store import folder_once, union_sources, write_graph
from . import sql
from .inputs import TEST_BUCKETS, batch_names, merged_graph, raw_graph
from .lookups import _BATCH_ALL, _FOUND, _REFERENCE, _references_sql
from .merging import _SYMBOLS, _source
from .registry import register

_MENTIONS = f"{sql.MERGED} SELECT source, chunk_id, symbol_source, symbol_id, role FROM mment"
_RANGES = f"{sql.MERGED} SELECT source, symbol_source, symbol_id, doc_id, start_line, start_char, end_line, end_char FROM mrange"
_DOCUMENTS = f"{sql.MERGED} SELECT source, doc_id, relative_path, language FROM mdocs"


def _grown(spark, folder):
    """Five sources added one by one; one of them comes half at first and whole later, a sixth comes and goes."""
    def write(place):
        raw = raw_graph(spark, folder)
        of = lambda name: _source(raw, lambda s: s == name)
        half = of("repo-0")
        segments.create_segments(spark, place, buckets=TEST_BUCKETS)
        segments.append_source(spark, place, "repo-0", half.with_tables(symbols=half.symbols.filter("symbol_id % 2 = 0")))
        segments.append_source(spark, place, "repo-1", of("repo-1"))
        segments.append_source(spark, place, "visitor", of("repo-4"))
        segments.append_source(spark, place, "repo-2", of("repo-2"))
        segments.append_source(spark, place, "repo-3", of("repo-3"))
        segments.replace_source(spark, place, "repo-0", of("repo-0"))
        segments.remove_source(spark, place, "visitor")
        segments.append_source(spark, place, "repo-4", of("repo-4"))

    return segments.load_segments(spark, folder_once(spark, f"grown{folder}", write))


@register("grown_symbols", _SYMBOLS)
def _(spark, folder):
    return _grown(spark, folder).symbols.select("symbol_source", "symbol_id", "symbol")


@register("grown_mentions", _MENTIONS)
def _(spark, folder):
    return _grown(spark, folder).mentions


@register("grown_ranges", _RANGES)
def _(spark, folder):
    return _grown(spark, folder).definition_ranges


@register("grown_documents", _DOCUMENTS)
def _(spark, folder):
    return _grown(spark, folder).documents.select("source", "doc_id", "relative_path", "language")


@register("grown_references", f"{_references_sql(_BATCH_ALL, _REFERENCE, None)} SELECT {_FOUND} FROM found")
def _(spark, folder):
    return lookup.find_references(_grown(spark, folder), batch_names(spark, folder)).select(*_FOUND.split(", "))


def _united(spark, folder):
    """The five sources from a folder each, and a folder that holds no graph."""
    def write(place):
        raw = raw_graph(spark, folder)
        for n in range(5):
            write_graph(_source(raw, lambda s, n=n: s == f"repo-{n}"), f"{place}/repo-{n}", sites=False)

    place = folder_once(spark, f"united{folder}", write)
    return union_sources(spark, [(name, f"{place}/{name}") for name in ("repo-0", "repo-1", "gone", "repo-2", "repo-3", "repo-4")])


@register("united_symbols", _SYMBOLS)
def _(spark, folder):
    return _united(spark, folder).symbols.select("symbol_source", "symbol_id", "symbol")


@register("united_mentions", _MENTIONS)
def _(spark, folder):
    return _united(spark, folder).mentions.select("source", "chunk_id", "symbol_source", "symbol_id", "role")


@register("united_documents", _DOCUMENTS)
def _(spark, folder):
    return _united(spark, folder).documents.select("source", "doc_id", "relative_path", "language")


def _every_name(graph):
    """Every display name as a query."""
    shown = graph.named_symbols().select(F.col("display_name").alias("query_id")).distinct()
    return shown.withColumn("name", F.col("query_id"))


_NAMED = f"{sql.MERGED}, named AS (SELECT *, {sql.display('symbol')} AS shown FROM msym)"


@register("resolve_exact_names", f"""{_NAMED} SELECT DISTINCT shown AS query_id, shown AS name, symbol, shown AS display_name,
  true AS is_exact FROM named""")
def _(spark, folder):
    graph = merged_graph(spark, folder)
    return lookup.resolve_symbols(graph, _every_name(graph), match="exact")


@register("resolve_display_names", f"""{_NAMED} SELECT q.shown AS query_id, q.shown AS name, s.symbol, s.shown AS display_name,
  s.shown = q.shown AS is_exact
FROM (SELECT DISTINCT shown FROM named) q JOIN named s ON contains(lower(s.symbol), lower(q.shown))""")
def _(spark, folder):
    graph = merged_graph(spark, folder)
    return lookup.resolve_symbols(graph, _every_name(graph), match="literal")


def _by_sql(spark, folder, query):
    graph = merged_graph(spark, folder)
    register_graph_functions(spark, graph)
    _every_name(graph).createOrReplaceTempView("asked_names")
    return spark.sql(query)


_AT = "s.symbol_source = q.symbol_source AND s.symbol_id = q.symbol_id"


@register("sql_references", f"""{_NAMED} SELECT q.shown AS name, q.symbol, s.source, s.file, s.start_line, s.end_line, s.role
FROM named q JOIN sites s ON {_AT} WHERE s.role <> 0 AND (s.role & 1) = 0""")
def _(spark, folder):
    return _by_sql(spark, folder, "SELECT q.name, r.* FROM asked_names q, LATERAL references_of(q.name) r")


@register("sql_definitions", f"""{_NAMED} SELECT q.shown AS name, q.symbol, s.source, s.file, s.start_line, s.end_line, s.start_char, s.end_char
FROM named q JOIN rsites s ON {_AT}""")
def _(spark, folder):
    return _by_sql(spark, folder, "SELECT q.name, d.* FROM asked_names q, LATERAL definitions_of(q.name) d")


@register("sql_relationships", f"""{_NAMED} SELECT q.symbol, r.target, r.is_reference, r.is_implementation
FROM named q JOIN rels r ON r.source = q.symbol_source AND r.symbol_id = q.symbol_id""")
def _(spark, folder):
    return _by_sql(spark, folder, "SELECT s.symbol, r.* FROM graph_names s, LATERAL relationships_of(s.symbol) r")
