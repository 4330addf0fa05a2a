"""Definitions, references, implementations, event flow and source windows."""

from pyspark.sql import functions as F

from ..constants import EVENT_FLOW_LIMIT, GREP_MAX_BODY_LINES, GREP_MAX_CONTEXT, GREP_REFERENCE_LIMIT, MAX_RESULTS
from ..functions.events import Recognizers, recognizers_from_json
from ..operators import eventflow, grep, lookup, reports
from . import sql
from .inputs import MESSAGES, NAMES, batch_names, merged_graph, rows, text_graph, text_lines
from .registry import register

_ASKED = sql.values("name", NAMES)
_BASE = f"{sql.MERGED}, {_ASKED}, {sql.matched()}"
_BATCH = f"{sql.MERGED}, {sql.BATCH_NAMES}, {sql.matched()}"
_BATCH_ALL = f"{sql.MERGED}, {sql.BATCH_NAMES}, {sql.matched(cap=None)}"
_ORDER = ("CASE WHEN m.is_exact THEN 0 ELSE 1 END, m.length_rank, x.file, x.start_line, x.start_char NULLS FIRST, x.end_line, "
          "x.end_char NULLS FIRST, x.source, x.symbol_source, x.symbol_id")
_COLUMNS = "query_id, name, symbol, display_name, source, file, start_line, end_line, start_char, end_char"


def _resolve_sql(base):
    return f"""{base}
SELECT query_id, name, symbol, display_name, is_exact, CAST(dense_rank() OVER (
  PARTITION BY query_id ORDER BY CASE WHEN is_exact THEN 0 ELSE 1 END, length_rank) AS INTEGER) AS rank
FROM (SELECT DISTINCT query_id, name, symbol, display_name, is_exact, length_rank FROM matched)"""


@register("resolve_symbols", _resolve_sql(_BASE))
def _(spark, folder):
    return lookup.resolve_symbols(merged_graph(spark, folder), rows(spark, "name", NAMES), cap=MAX_RESULTS)


@register("resolve_symbols_batch", _resolve_sql(_BATCH))
def _(spark, folder):
    return lookup.resolve_symbols(merged_graph(spark, folder), batch_names(spark, folder), cap=MAX_RESULTS)


@register("resolve_symbols_exact_first", _resolve_sql(f"{sql.MERGED}, {_ASKED}, {sql.matched(exact_first=True)}"))
def _(spark, folder):
    return lookup.resolve_symbols(merged_graph(spark, folder), rows(spark, "name", NAMES), exact_first=True, cap=MAX_RESULTS)


@register("resolve_symbols_literal", f"""{sql.MERGED}, {_ASKED}
SELECT q.query_id, q.name, s.symbol, {sql.display('s.symbol')} AS display_name,
  ({sql.display('s.symbol')} = q.name) AS is_exact
FROM asked q JOIN msym s ON contains(lower(s.symbol), lower(q.name))""")
def _(spark, folder):
    return lookup.resolve_symbols(merged_graph(spark, folder), rows(spark, "name", NAMES), match="literal", cap=None)


@register("resolve_symbols_all", f"""{_BATCH_ALL} SELECT DISTINCT query_id, name, symbol, display_name, is_exact FROM matched""")
def _(spark, folder):
    return lookup.resolve_symbols(merged_graph(spark, folder), batch_names(spark, folder))


@register("unmatched_queries", f"{_BASE} SELECT query_id, name FROM asked WHERE query_id NOT IN (SELECT query_id FROM matched)")
def _(spark, folder):
    asked = rows(spark, "name", NAMES)
    return lookup.unmatched(asked, lookup.resolve_symbols(merged_graph(spark, folder), asked, cap=MAX_RESULTS))


_DEFINITIONS = f"""precise AS (
  SELECT m.query_id, m.name, m.symbol, m.display_name, m.is_exact, m.length_rank, x.source, x.symbol_source, x.symbol_id,
    x.file, x.start_line, x.end_line, x.start_char, x.end_char
  FROM matched m JOIN rsites x ON x.symbol_source = m.symbol_source AND x.symbol_id = m.symbol_id),
spare AS (
  SELECT m.query_id, m.name, m.symbol, m.display_name, m.is_exact, m.length_rank, x.source, x.symbol_source, x.symbol_id,
    x.file, x.start_line, x.end_line, CAST(NULL AS INTEGER) AS start_char, CAST(NULL AS INTEGER) AS end_char
  FROM matched m JOIN sites x ON x.symbol_source = m.symbol_source AND x.symbol_id = m.symbol_id
  WHERE x.role = 1 AND NOT EXISTS (
    SELECT 1 FROM precise p WHERE p.query_id = m.query_id AND p.length_rank = m.length_rank)),
hits AS (SELECT * FROM precise UNION ALL SELECT * FROM spare),
numbered AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {_ORDER.replace('m.', '').replace('x.', '')}) AS rn
  FROM hits)"""


@register("find_definitions", f"{_BASE}, {_DEFINITIONS} SELECT {_COLUMNS} FROM numbered WHERE rn <= 50")
def _(spark, folder):
    return lookup.find_definitions(merged_graph(spark, folder), rows(spark, "name", NAMES), limit=MAX_RESULTS, cap=MAX_RESULTS)


@register("find_definitions_batch", f"{_BATCH}, {_DEFINITIONS} SELECT {_COLUMNS} FROM numbered WHERE rn <= 50")
def _(spark, folder):
    return lookup.find_definitions(merged_graph(spark, folder), batch_names(spark, folder), limit=MAX_RESULTS, cap=MAX_RESULTS)


@register("find_definitions_uncapped", f"{_BATCH_ALL}, {_DEFINITIONS} SELECT {_COLUMNS} FROM numbered")
def _(spark, folder):
    return lookup.find_definitions(merged_graph(spark, folder), batch_names(spark, folder), limit=None, cap=None)


def _references_sql(base, role, limit):
    cut = "" if limit is None else f"WHERE rn <= {limit}"
    return f"""{base}, numbered AS (
  SELECT m.query_id, m.name, m.symbol, m.display_name, m.is_exact, m.length_rank, x.source, x.file, x.start_line, x.end_line, x.role,
    row_number() OVER (PARTITION BY m.query_id ORDER BY CASE WHEN m.is_exact THEN 0 ELSE 1 END, m.length_rank, x.file,
      x.start_line, x.end_line, x.source, x.symbol_source, x.symbol_id, x.role) AS rn
  FROM matched m JOIN sites x ON x.symbol_source = m.symbol_source AND x.symbol_id = m.symbol_id WHERE {role}),
found AS (SELECT * FROM numbered {cut})"""


_REFERENCE = "x.role <> 0 AND (x.role & 1) = 0"
_FOUND = "query_id, name, symbol, display_name, source, file, start_line, end_line, role"


@register("find_references", f"{_references_sql(_BASE, _REFERENCE, 50)} SELECT {_FOUND} FROM found")
def references(spark, folder):
    return lookup.find_references(merged_graph(spark, folder), rows(spark, "name", NAMES), limit=MAX_RESULTS, cap=MAX_RESULTS).select(*_FOUND.split(", "))


@register("find_references_batch", f"{_references_sql(_BATCH, _REFERENCE, 50)} SELECT {_FOUND} FROM found")
def _(spark, folder):
    return lookup.find_references(merged_graph(spark, folder), batch_names(spark, folder), limit=MAX_RESULTS, cap=MAX_RESULTS).select(*_FOUND.split(", "))


@register("find_references_uncapped", f"{_references_sql(_BATCH_ALL, _REFERENCE, None)} SELECT {_FOUND} FROM found")
def _(spark, folder):
    found = lookup.find_references(merged_graph(spark, folder), batch_names(spark, folder), limit=None, cap=None)
    return found.select(*_FOUND.split(", "))


@register("find_references_with_defs", f"{_references_sql(_BASE, 'x.role <> 0', 50)} SELECT {_FOUND} FROM found")
def _(spark, folder):
    found = lookup.find_references(merged_graph(spark, folder), rows(spark, "name", NAMES), include_definition=True, limit=MAX_RESULTS, cap=MAX_RESULTS)
    return found.select(*_FOUND.split(", "))


@register("find_references_any_role", f"{_references_sql(_BASE, '(x.role & 1) = 0', 50)} SELECT {_FOUND} FROM found")
def _(spark, folder):
    found = lookup.find_references(merged_graph(spark, folder), rows(spark, "name", NAMES), role_policy="scip", limit=MAX_RESULTS, cap=MAX_RESULTS)
    return found.select(*_FOUND.split(", "))


@register("references_by_name", f"""{_references_sql(_BASE, _REFERENCE, 50)}
SELECT query_id, display_name, count(*) AS n_occurrences, string_agg(file || ':' || CAST(start_line AS VARCHAR) || '-'
  || CAST(end_line AS VARCHAR), ', ' ORDER BY length_rank, file, start_line, end_line) AS locations
FROM found GROUP BY query_id, display_name""")
def _(spark, folder):
    found = lookup.find_references(merged_graph(spark, folder), rows(spark, "name", NAMES), limit=MAX_RESULTS, cap=MAX_RESULTS)
    return reports.references_by_name(found, MAX_RESULTS).withColumn("locations", F.array_join("locations", ", "))


@register("find_references_with_defs_all", f"{_references_sql(_BATCH_ALL, 'x.role <> 0', None)} SELECT {_FOUND} FROM found")
def _(spark, folder):
    found = lookup.find_references(merged_graph(spark, folder), batch_names(spark, folder), include_definition=True)
    return found.select(*_FOUND.split(", "))


@register("find_references_any_role_all", f"{_references_sql(_BATCH_ALL, '(x.role & 1) = 0', None)} SELECT {_FOUND} FROM found")
def _(spark, folder):
    return lookup.find_references(merged_graph(spark, folder), batch_names(spark, folder), role_policy="scip").select(*_FOUND.split(", "))


@register("references_by_name_all", f"""{_references_sql(_BATCH_ALL, _REFERENCE, None)}
SELECT query_id, display_name, file || ':' || CAST(start_line AS VARCHAR) || '-' || CAST(end_line AS VARCHAR) AS location FROM found""")
def _(spark, folder):
    return reports.references_by_name(lookup.find_references(merged_graph(spark, folder), batch_names(spark, folder)))


@register("reference_site_counts_all", f"""{_references_sql(_BATCH_ALL, _REFERENCE, None)}
SELECT query_id, count(DISTINCT file || ':' || CAST(start_line AS VARCHAR)) AS n_sites FROM found GROUP BY query_id""")
def _(spark, folder):
    return grep.reference_site_counts(lookup.find_references(merged_graph(spark, folder), batch_names(spark, folder)))


@register("capped_queries", f"""{_references_sql(_BASE, _REFERENCE, 50)}
SELECT query_id, count(*) AS n_results, count(*) >= 50 AS capped FROM found GROUP BY query_id""")
def _(spark, folder):
    found = lookup.find_references(merged_graph(spark, folder), rows(spark, "name", NAMES), limit=MAX_RESULTS, cap=MAX_RESULTS)
    return lookup.with_cap_flag(found).groupBy("query_id", "capped").agg(F.count(F.lit(1)).alias("n_results"))


@register("reference_site_counts", f"""{_references_sql(_BASE, _REFERENCE, 15)}
SELECT query_id, count(DISTINCT file || ':' || CAST(start_line AS VARCHAR)) AS n_sites FROM found GROUP BY query_id""")
def _(spark, folder):
    return grep.reference_site_counts(
        lookup.find_references(merged_graph(spark, folder), rows(spark, "name", NAMES), limit=15, cap=MAX_RESULTS),
    )


_MREL = f"""mrel AS (
  SELECT s.symbol_source, s.symbol_id, s.symbol, r.target, r.is_implementation, r.is_reference
  FROM rels r JOIN msym s ON s.symbol_source = r.source AND s.symbol_id = r.symbol_id)"""


def _implementations_sql(base, same, limit=50):
    return f"""{base}, {_MREL},
pairs2 AS (SELECT DISTINCT m.query_id, m.name, r.symbol_source, r.symbol_id, r.symbol
  FROM mrel r JOIN matched m ON {same} WHERE r.is_implementation AND m.name <> ''),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol_source, symbol_id
  ORDER BY file, start_line, start_char, end_line, end_char, source) AS k FROM rsites) WHERE k = 1),
numbered AS (SELECT p.query_id, p.name, p.symbol, {sql.display('p.symbol')} AS display_name, f.source, f.file, f.start_line,
  f.end_line, f.start_char, f.end_char,
  row_number() OVER (PARTITION BY p.query_id ORDER BY p.symbol_source, p.symbol_id) AS rn
  FROM pairs2 p JOIN firsts f ON f.symbol_source = p.symbol_source AND f.symbol_id = p.symbol_id)
SELECT {_COLUMNS} FROM numbered WHERE rn <= {limit}"""


@register("find_implementations", _implementations_sql(_BASE, "r.target = m.symbol"))
def _(spark, folder):
    return lookup.find_implementations(merged_graph(spark, folder), rows(spark, "name", NAMES), limit=MAX_RESULTS, cap=MAX_RESULTS)


@register("find_implementations_all", _implementations_sql(_BATCH_ALL, "r.target = m.symbol", 1 << 60))
def _(spark, folder):
    return lookup.find_implementations(merged_graph(spark, folder), batch_names(spark, folder))


@register("find_implementations_by_key", _implementations_sql(
    _BATCH, f"{sql.KEY.format('r.target', repr(''))} = {sql.KEY.format('m.symbol', repr(''))}"))
def _(spark, folder):
    return lookup.find_implementations(merged_graph(spark, folder), batch_names(spark, folder), by_key=True, limit=MAX_RESULTS, cap=MAX_RESULTS)


@register("find_implementations_by_key_all", _implementations_sql(
    _BATCH_ALL, f"{sql.KEY.format('r.target', repr(''))} = {sql.KEY.format('m.symbol', repr(''))}", 1 << 60))
def _(spark, folder):
    return lookup.find_implementations(merged_graph(spark, folder), batch_names(spark, folder), by_key=True)


@register("relationships", f"""{sql.MERGED}, {_MREL}
SELECT symbol_source, symbol_id, symbol, target, is_reference, is_implementation FROM mrel""")
def _(spark, folder):
    return merged_graph(spark, folder).relationships().select(
        "symbol_source", "symbol_id", "symbol", "target", "is_reference", "is_implementation",
    )


# --- event flow -------------------------------------------------------------------------

_RULES = Recognizers(produce=("red", "blue"), consume=("small", "large"))


def _hits(tokens):
    return " + ".join(f"CAST(regexp_matches(names, '(^|[^a-z0-9]){t}') AS INTEGER)" for t in tokens)


def _flow_sql(cap, limit, near):
    base = f"{sql.MERGED}, {sql.values('name', MESSAGES)}, {sql.matched(cap=cap)}"
    cut = "" if near is None else f"WHERE k <= {near}"
    return f"""{_references_sql(base, "x.role <> 0", limit)},
near AS (
  SELECT p.file, p.line, s.symbol, row_number() OVER (PARTITION BY p.file, p.line ORDER BY s.symbol) AS k
  FROM (SELECT DISTINCT file, start_line AS line FROM found) p
  JOIN (SELECT DISTINCT file, start_line, end_line, symbol FROM sites) s
    ON s.file = p.file AND s.start_line <= p.line AND s.end_line >= p.line),
names AS (SELECT file, line, lower(string_agg({sql.display('symbol')}, ' ' ORDER BY symbol)) AS names
  FROM (SELECT DISTINCT file, line, symbol, k FROM near) {cut} GROUP BY file, line),
scored AS (
  SELECT f.*, lower(f.file) AS p, {_hits(("red", "blue"))} AS prod, {_hits(("small", "large"))} AS cons
  FROM found f JOIN names n ON n.file = f.file AND n.line = f.start_line),
flow AS (
  SELECT query_id, name, symbol, display_name, file, start_line, end_line, CASE
    WHEN contains(p, '.pb.go') OR contains(p, '.pb.') OR contains(p, '_pb2.') OR contains(p, '.proto') THEN 'definition'
    WHEN cons > prod THEN 'consumer' WHEN prod > cons THEN 'producer'
    WHEN contains(p, 'consumer') OR contains(p, 'subscriber') OR contains(p, 'handler') OR contains(p, 'listener')
      THEN 'consumer'
    WHEN contains(p, 'publisher') OR contains(p, 'producer') OR contains(p, '/emit') THEN 'producer'
    ELSE 'unknown' END AS flow_role, split_part(file, '/', 1) AS repo,
    file || ':' || CAST(start_line AS VARCHAR) || '-' || CAST(end_line AS VARCHAR) AS location
  FROM scored)"""


_FLOW, _FLOW_ALL = _flow_sql(50, 60, 50), _flow_sql(None, None, None)


def _flow(spark, folder):
    return eventflow.event_flow_sites(merged_graph(spark, folder), rows(spark, "name", MESSAGES), _RULES, limit=EVENT_FLOW_LIMIT, per_site=MAX_RESULTS, cap=MAX_RESULTS)


@register("event_flow_sites", f"""{_FLOW} SELECT query_id, name, symbol, display_name, file, start_line, end_line, flow_role, repo,
  location FROM flow""")
def _(spark, folder):
    return _flow(spark, folder)


def _whole_flow(spark, folder):
    return eventflow.event_flow_sites(merged_graph(spark, folder), rows(spark, "name", MESSAGES), _RULES)


@register("event_flow_sites_all", f"""{_FLOW_ALL} SELECT query_id, name, symbol, display_name, file, start_line, end_line, flow_role, repo,
  location FROM flow""")
def _(spark, folder):
    return _whole_flow(spark, folder)


@register("event_flow_by_repo_all", f"""{_FLOW_ALL}
SELECT query_id, CASE WHEN flow_role IN ('producer', 'consumer') THEN flow_role ELSE 'other' END AS role_group, repo,
  count(*) AS n_sites FROM flow GROUP BY ALL""")
def _(spark, folder):
    return eventflow.event_flow_by_repo(_whole_flow(spark, folder))


@register("event_flow_repos_all", f"""{_FLOW_ALL}
SELECT DISTINCT query_id, flow_role, repo FROM flow WHERE flow_role IN ('producer', 'consumer')""")
def _(spark, folder):
    return eventflow.event_flow_repos(_whole_flow(spark, folder))


@register("event_flow_by_repo", f"""{_FLOW}
SELECT query_id, CASE WHEN flow_role IN ('producer', 'consumer') THEN flow_role ELSE 'other' END AS role_group, repo,
  count(*) AS n_sites, string_agg(location, ', ' ORDER BY location) AS locations FROM flow GROUP BY ALL""")
def _(spark, folder):
    return eventflow.event_flow_by_repo(_flow(spark, folder), EVENT_FLOW_LIMIT).withColumn("locations", F.array_join("locations", ", "))


@register("event_flow_summary", f"""{_FLOW}, sides AS (
  SELECT query_id, string_agg(CASE WHEN flow_role = 'producer' THEN repo END, ', ' ORDER BY repo) AS producers,
    string_agg(CASE WHEN flow_role = 'consumer' THEN repo END, ', ' ORDER BY repo) AS consumers
  FROM (SELECT DISTINCT query_id, flow_role, repo FROM flow WHERE flow_role IN ('producer', 'consumer')) GROUP BY query_id)
SELECT query_id, coalesce(producers, '') AS producers, coalesce(consumers, '') AS consumers,
  producers || ' → ' || consumers AS flow FROM sides""")
def _(spark, folder):
    summary = eventflow.event_flow_summary(_flow(spark, folder))
    return summary.select(
        "query_id", F.array_join("producers", ", ").alias("producers"), F.array_join("consumers", ", ").alias("consumers"),
        "flow",
    )


@register("event_flow_from_table_config", f"{_FLOW} SELECT flow_role, count(*) AS n_sites FROM flow GROUP BY flow_role")
def _(spark, folder):
    raw = F.lit('{"produce": ["RED", "blue"], "consume": ["small", "large"], "consume_paths": 3}')
    config = spark.range(1).select(recognizers_from_json(raw).alias("recognizers"))
    sites = eventflow.event_flow_sites(merged_graph(spark, folder), rows(spark, "name", MESSAGES), config, limit=EVENT_FLOW_LIMIT, per_site=MAX_RESULTS, cap=MAX_RESULTS)
    return sites.groupBy("flow_role").agg(F.count(F.lit(1)).alias("n_sites"))


# --- source windows ---------------------------------------------------------------------

_TEXT_SITES = """sites AS (
  SELECT m.source, m.source AS symbol_source, m.symbol_id, s.symbol, m.role, d.relative_path AS file, c.start_line, c.end_line
  FROM mentions m JOIN chunks c ON c.source = m.source AND c.chunk_id = m.chunk_id
  JOIN docs d ON d.source = c.source AND d.doc_id = c.doc_id JOIN symbols s ON s.source = m.source AND s.symbol_id = m.symbol_id),
rsites AS (
  SELECT r.source, r.source AS symbol_source, r.symbol_id, s.symbol, d.relative_path AS file, r.start_line, r.end_line,
    r.start_char, r.end_char
  FROM ranges r JOIN docs d ON d.source = r.source AND d.doc_id = r.doc_id
  JOIN symbols s ON s.source = r.source AND s.symbol_id = r.symbol_id),
all_lines AS (
  SELECT source, file, CAST(n - 1 AS INTEGER) AS line_no, parts[n] AS line, len(parts) AS n_lines FROM (
    SELECT source, file, parts, unnest(range(1, len(parts) + 1)) AS n FROM (
      SELECT o.source, t.lang || '/doc_' || CAST(t.doc_id AS VARCHAR) || '.txt' AS file,
        string_split(CASE WHEN t.text LIKE '%' || chr(10) THEN left(t.text, length(t.text) - 1) ELSE t.text END, chr(10)) AS parts
      FROM documents t JOIN docs o ON o.doc_id = t.doc_id WHERE t.text <> '')))"""
_RAW_SYMBOLS = "rawsym AS (SELECT source AS symbol_source, symbol_id, symbol FROM symbols)"
_TEXT_BASE = f"{sql.RAW_TEXT}, {_TEXT_SITES}, {_RAW_SYMBOLS}, {sql.BATCH_NAMES}, {sql.matched('rawsym')}"


def _window_sql(windows):
    return f"""{windows},
shown AS (
  SELECT w.query_id, w.symbol, w.source, w.file, w.start_line, w.truncated, l.line_no, l.line
  FROM (SELECT DISTINCT query_id, symbol, source, file, start_line, end_line, first_line, last_line, truncated FROM windows) w
  LEFT JOIN all_lines l ON l.source = w.source AND l.file = w.file
    AND l.line_no BETWEEN greatest(0, w.first_line) AND w.last_line)
SELECT query_id, symbol, source, file, start_line, truncated, line_no, printf('  %5d ', line_no + 1) || line AS numbered,
  (source, file) IN (SELECT source, file FROM all_lines) AS source_available FROM shown"""


_SHOWN = ["query_id", "symbol", "source", "file", "start_line", "truncated", "line_no", "numbered", "source_available"]


@register("grep_definition_body", _window_sql(f"""{_TEXT_BASE}, {_DEFINITIONS}, windows AS (
  SELECT query_id, symbol, source, file, start_line, end_line, start_line AS first_line,
    CASE WHEN end_line - start_line + 1 > 120 THEN start_line + 119 ELSE end_line END AS last_line,
    end_line - start_line + 1 > 120 AS truncated FROM numbered WHERE rn <= 50)"""))
def _(spark, folder):
    found = lookup.find_definitions(text_graph(spark, folder), batch_names(spark, folder), limit=MAX_RESULTS, cap=MAX_RESULTS)
    lines = text_lines(spark, folder)
    return grep.window_lines(grep.definition_bodies(found, GREP_MAX_BODY_LINES), lines).select(*_SHOWN)


@register("grep_reference_windows", _window_sql(f"""{_references_sql(_TEXT_BASE, _REFERENCE, 15)}, windows AS (
  SELECT query_id, symbol, source, file, start_line, end_line, start_line - 3 AS first_line, end_line + 3 AS last_line,
    false AS truncated FROM found)"""))
def _(spark, folder):
    found = lookup.find_references(text_graph(spark, folder), batch_names(spark, folder), limit=15, cap=MAX_RESULTS)
    lines = text_lines(spark, folder)
    return grep.window_lines(grep.reference_windows(found), lines).select(*_SHOWN)


_TEXT_ALL = f"{sql.RAW_TEXT}, {_TEXT_SITES}, {_RAW_SYMBOLS}, {sql.BATCH_NAMES}, {sql.matched('rawsym', cap=None)}"


@register("grep_definition_body_all", _window_sql(f"""{_TEXT_ALL}, {_DEFINITIONS}, windows AS (
  SELECT query_id, symbol, source, file, start_line, end_line, start_line AS first_line, end_line AS last_line,
    false AS truncated FROM numbered)"""))
def _(spark, folder):
    found = lookup.find_definitions(text_graph(spark, folder), batch_names(spark, folder))
    return grep.window_lines(grep.definition_bodies(found), text_lines(spark, folder)).select(*_SHOWN)


@register("grep_reference_windows_all", _window_sql(f"""{_references_sql(_TEXT_ALL, _REFERENCE, None)}, windows AS (
  SELECT query_id, symbol, source, file, start_line, end_line, start_line - 3 AS first_line, end_line + 3 AS last_line,
    false AS truncated FROM found)"""))
def _(spark, folder):
    found = lookup.find_references(text_graph(spark, folder), batch_names(spark, folder))
    return grep.window_lines(grep.reference_windows(found), text_lines(spark, folder)).select(*_SHOWN)


_PARTS = f"""{_references_sql(f"{_TEXT_BASE}, {_DEFINITIONS.replace('numbered AS', 'numbered_defs AS')}", _REFERENCE, 15)},
windows AS (
  SELECT DISTINCT query_id, symbol, source, file, start_line, end_line, start_char, start_line AS first_line,
    CASE WHEN end_line - start_line + 1 > 120 THEN start_line + 119 ELSE end_line END AS last_line, 'definition' AS part
  FROM numbered_defs WHERE rn <= 50
  UNION ALL
  SELECT DISTINCT query_id, symbol, source, file, start_line, end_line, CAST(NULL AS INTEGER), start_line - 10,
    end_line + 10, 'reference' FROM found)
SELECT w.query_id, w.part, count(l.line) AS n_lines, CAST(coalesce(sum(length(l.line)), 0) AS BIGINT) AS n_chars
FROM windows w LEFT JOIN all_lines l ON l.source = w.source AND l.file = w.file
  AND l.line_no BETWEEN greatest(0, w.first_line) AND w.last_line
GROUP BY w.query_id, w.part"""


@register("grep_symbols_all", _PARTS.replace(_TEXT_BASE, _TEXT_ALL).replace("WHERE rn <= 50", "").replace("WHERE rn <= 15", "").replace(
    "CASE WHEN end_line - start_line + 1 > 120 THEN start_line + 119 ELSE end_line END", "end_line"))
def _(spark, folder):
    shown = grep.grep_symbols(text_graph(spark, folder), batch_names(spark, folder), text_lines(spark, folder), context=GREP_MAX_CONTEXT)
    return shown.groupBy("query_id", "part").agg(
        F.count("line").alias("n_lines"), F.coalesce(F.sum(F.length("line")), F.lit(0)).alias("n_chars"),
    )


@register("grep_symbols", _PARTS)
def _(spark, folder):
    lines = text_lines(spark, folder)
    shown = grep.grep_symbols(text_graph(spark, folder), batch_names(spark, folder), lines, context=GREP_MAX_CONTEXT,
        definition_limit=MAX_RESULTS, reference_limit=GREP_REFERENCE_LIMIT, body_lines=GREP_MAX_BODY_LINES, cap=MAX_RESULTS)
    return shown.groupBy("query_id", "part").agg(
        F.count("line").alias("n_lines"), F.coalesce(F.sum(F.length("line")), F.lit(0)).alias("n_chars"),
    )
