"""Queries that start from a path or a position."""

from pyspark.sql import functions as F

from ..constants import MAX_RESULTS
from ..operators import files, reports
from . import sql
from .inputs import SCOPES, merged_graph, rows, wide_graph
from .registry import register

_LISTED = f"""{sql.MERGED}, {sql.values("scope", SCOPES)}, numbered AS (
  SELECT q.query_id, q.scope, x.symbol, {sql.display('x.symbol')} AS display_name, x.source, x.file, x.start_line, x.end_line,
    x.start_char, x.end_char, row_number() OVER (PARTITION BY q.query_id
      ORDER BY x.file, x.start_line, x.start_char, x.end_line, x.end_char, x.symbol, x.source) AS rn
  FROM asked q JOIN rsites x ON {{0}} WHERE q.scope <> ''),
listed AS (SELECT query_id, scope, symbol, display_name, source, file, start_line, end_line, start_char, end_char
  FROM numbered WHERE rn <= 50)"""
_PREFIX = _LISTED.format("x.file ILIKE rtrim(q.scope, '/') || '%'")
_BOUNDARY = _LISTED.format("x.file ILIKE rtrim(q.scope, '/') OR x.file ILIKE rtrim(q.scope, '/') || '/%'")


@register("list_symbols", f"{_PREFIX} SELECT * FROM listed")
def _(spark, folder):
    return files.list_symbols(merged_graph(spark, folder), rows(spark, "scope", SCOPES), limit=MAX_RESULTS)


@register("list_symbols_boundary", f"{_BOUNDARY} SELECT * FROM listed")
def _(spark, folder):
    return files.list_symbols(merged_graph(spark, folder), rows(spark, "scope", SCOPES), boundary=True, limit=MAX_RESULTS)


@register("list_symbols_all", f"{_PREFIX.replace('WHERE rn <= 50', '')} SELECT * FROM listed")
def _(spark, folder):
    return files.list_symbols(merged_graph(spark, folder), rows(spark, "scope", SCOPES))


@register("list_symbols_boundary_all", f"{_BOUNDARY.replace('WHERE rn <= 50', '')} SELECT * FROM listed")
def _(spark, folder):
    return files.list_symbols(merged_graph(spark, folder), rows(spark, "scope", SCOPES), boundary=True)


def all_folders(graph):
    """Every folder of the graph as a scope."""
    folder = F.concat(F.substring_index("relative_path", "/", 2), F.lit("/"))
    return graph.documents.select(folder.alias("query_id"), folder.alias("scope")).distinct()


@register("list_symbols_by_folder", f"""{sql.MERGED},
asked AS (SELECT DISTINCT split_part(relative_path, '/', 1) || '/' || split_part(relative_path, '/', 2) || '/' AS scope FROM mdocs)
SELECT q.scope AS query_id, x.symbol, x.file, x.start_line, x.end_line
FROM asked q JOIN rsites x ON x.file ILIKE rtrim(q.scope, '/') || '%'""")
def _(spark, folder):
    graph = merged_graph(spark, folder)
    found = files.list_symbols(graph, all_folders(graph), limit=None)
    return found.select("query_id", "symbol", "file", "start_line", "end_line")


@register("symbols_by_file", f"""{_PREFIX}
SELECT query_id, file, string_agg(display_name || ' (line ' || CAST(start_line AS VARCHAR) || ')', ', '
  ORDER BY start_line, display_name) AS symbols FROM listed GROUP BY query_id, file""")
def _(spark, folder):
    listed = files.list_symbols(merged_graph(spark, folder), rows(spark, "scope", SCOPES), limit=MAX_RESULTS)
    return reports.symbols_by_file(listed, MAX_RESULTS).withColumn("symbols", F.array_join("symbols", ", "))


@register("symbols_by_file_all", f"""{_PREFIX.replace('WHERE rn <= 50', '')}
SELECT query_id, file, display_name || ' (line ' || CAST(start_line AS VARCHAR) || ')' AS entry FROM listed""")
def _(spark, folder):
    return reports.symbols_by_file(files.list_symbols(merged_graph(spark, folder), rows(spark, "scope", SCOPES)))


_IMPORTS = f"""{sql.MERGED}, found AS (SELECT DISTINCT file AS query_id, file, symbol, {sql.display('symbol')} AS display_name
  FROM sites WHERE role <> 0 AND (role & 1) = 0)"""


def all_files(graph):
    return graph.documents.select(F.col("relative_path").alias("query_id"), F.col("relative_path").alias("file"))


@register("get_imports", f"{_IMPORTS} SELECT query_id, file, symbol, display_name FROM found")
def _(spark, folder):
    graph = merged_graph(spark, folder)
    return files.get_imports(graph, all_files(graph), limit=MAX_RESULTS)


@register("import_names", f"""{_IMPORTS}
SELECT query_id, string_agg(display_name, ', ' ORDER BY display_name) AS names
FROM (SELECT DISTINCT query_id, display_name FROM found) GROUP BY query_id""")
def _(spark, folder):
    graph = merged_graph(spark, folder)
    return reports.joined_names(files.get_imports(graph, all_files(graph)))


_WIDE_IMPORTS = f"""{sql.WIDE}, found AS (SELECT DISTINCT file AS query_id, file, symbol, {sql.display('symbol')} AS display_name
  FROM wsites WHERE role <> 0 AND (role & 1) = 0)"""


@register("get_imports_all", f"{_WIDE_IMPORTS} SELECT query_id, file, symbol, display_name FROM found")
def _(spark, folder):
    graph = wide_graph(spark, folder)
    return files.get_imports(graph, all_files(graph))


@register("import_names_all", f"{_WIDE_IMPORTS} SELECT DISTINCT query_id, display_name FROM found")
def _(spark, folder):
    graph = wide_graph(spark, folder)
    return reports.distinct_names(files.get_imports(graph, all_files(graph)))


def all_positions(graph):
    """One line of every document."""
    return graph.documents.select(
        F.col("relative_path").alias("query_id"), F.col("relative_path").alias("file"),
        (F.col("doc_id") * 7 % 140).cast("int").alias("line"),
    )


@register("symbols_at", f"""{sql.MERGED}, asked AS (
  SELECT relative_path AS file, CAST(doc_id * 7 % 140 AS INTEGER) AS line FROM mdocs)
SELECT DISTINCT q.file AS query_id, q.file, q.line, s.symbol, {sql.display('s.symbol')} AS display_name
FROM asked q JOIN sites s ON s.file = q.file AND q.line BETWEEN s.start_line AND s.end_line""")
def _(spark, folder):
    graph = merged_graph(spark, folder)
    return files.symbols_at(graph, all_positions(graph), limit=MAX_RESULTS)


@register("symbols_at_all", f"""{sql.WIDE}, asked AS (
  SELECT relative_path AS file, CAST(doc_id * 7 % 140 AS INTEGER) AS line FROM wdocs)
SELECT DISTINCT q.file AS query_id, q.file, q.line, s.symbol, {sql.display('s.symbol')} AS display_name
FROM asked q JOIN wsites s ON s.file = q.file AND q.line BETWEEN s.start_line AND s.end_line""")
def _(spark, folder):
    graph = wide_graph(spark, folder)
    return files.symbols_at(graph, all_positions(graph))


@register("edge_sites", f"{sql.MERGED} SELECT source, symbol, role, file, start_line, end_line FROM sites")
def _(spark, folder):
    return merged_graph(spark, folder).sites().select(
        "source", "symbol", "role", F.col("relative_path").alias("file"), "start_line", "end_line",
    )


@register("definition_sites", f"{sql.MERGED} SELECT source, symbol, file, start_line, start_char, end_line, end_char FROM rsites")
def _(spark, folder):
    return merged_graph(spark, folder).definition_sites().select(
        "source", "symbol", F.col("relative_path").alias("file"), "start_line", "start_char", "end_line", "end_char",
    )
