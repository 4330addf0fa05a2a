"""Column expressions applied to whole tables."""

from pyspark.sql import functions as F

from ..functions import events, monikers, paths, ranges, roles, text
from ..functions.sql import register_sql_functions
from ..operators.grep import source_lines
from ..sources import starschema
from ..sources.starschema import text_files
from . import sql
from .inputs import raw_graph, table
from .registry import register

_PARTS = f"WITH {sql.PARTS}"


def _parts(spark, folder):
    return starschema.part_monikers(spark, folder)


@register("display_name", f"{_PARTS} SELECT part_id, symbol, {sql.display('symbol')} AS display_name FROM parts")
def _(spark, folder):
    return _parts(spark, folder).withColumn("display_name", monikers.display_name(F.col("symbol")))


def _visible(column):
    """The key separator as a bar, which both engines print alike."""
    return F.replace(column, F.lit("\0"), F.lit("|"))


_KEYED = f"""{sql.RAW} SELECT source, symbol_id, {sql.KEY.format('symbol', 'source')} AS symbol_key,
  CASE WHEN symbol LIKE 'local%' THEN source || '/' || symbol ELSE symbol END AS stored FROM symbols"""


@register("dedup_key", f"SELECT source, symbol_id, symbol_key FROM ({_KEYED})")
def _(spark, folder):
    return raw_graph(spark, folder).symbols.select(
        F.col("symbol_source").alias("source"), "symbol_id",
        _visible(monikers.dedup_key(F.col("symbol"), F.col("symbol_source"))).alias("symbol_key"),
    )


@register("storable_symbol", f"SELECT source, symbol_id, stored FROM ({_KEYED})")
def _(spark, folder):
    return raw_graph(spark, folder).symbols.select(
        F.col("symbol_source").alias("source"), "symbol_id",
        monikers.storable_symbol(F.col("symbol"), F.col("symbol_source")).alias("stored"),
    )


@register("sql_functions", _KEYED)
def _(spark, folder):
    register_sql_functions(spark)
    return raw_graph(spark, folder).symbols.selectExpr(
        "symbol_source AS source", "symbol_id", "replace(norm_moniker(symbol, symbol_source), chr(0), '|') AS symbol_key",
        "storable_symbol(symbol, symbol_source) AS stored",
    )


@register("moniker_parts", f"""{_PARTS} SELECT part_id, split_part(symbol, ' ', 1) AS scheme, split_part(symbol, ' ', 2) AS manager,
  CASE WHEN symbol LIKE 'scip%' THEN split_part(symbol, ' ', 3) END AS package,
  CASE WHEN symbol LIKE 'scip%' THEN split_part(symbol, ' ', 4) END AS version,
  CASE WHEN symbol LIKE 'scip%' THEN split_part(symbol, ' ', 5) END AS descriptor FROM parts""")
def _(spark, folder):
    return _parts(spark, folder).select("part_id", monikers.moniker_parts(F.col("symbol")).alias("p")).select("part_id", "p.*")


@register("package_symbols", f"{_PARTS} SELECT part_id, symbol FROM parts WHERE symbol LIKE 'scip%'")
def _(spark, folder):
    return _parts(spark, folder).filter(monikers.is_package_symbol(F.col("symbol")))


@register("descriptors", """SELECT p_partkey AS part_id,
  'resource/' || replace(p_name, ' ', '/') || CASE p_size % 5 WHEN 0 THEN '#' WHEN 1 THEN '#' WHEN 2 THEN '.' WHEN 3 THEN '.' ELSE '/' END AS terraform,
  'org/' || replace(lower(p_type) || '.' || p_name, '.', '/') || '#' AS proto,
  'scip-k8s . . . ' || CASE WHEN p_size % 2 = 0 THEN p_brand ELSE 'default' END || '/Secret/' || p_name || '#' AS k8s FROM part""")
def _(spark, folder):
    kind = F.element_at(F.array(*[F.lit(k) for k in (23, 5, 13, 8, 6)]), (F.col("p_size") % 5 + 1).cast("int"))
    quoted = F.concat(F.lit("resource  \""), F.replace("p_name", F.lit(" "), F.lit('" "')), F.lit('"\t""'))
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("part_id"), monikers.terraform_descriptor(quoted, kind).alias("terraform"),
        monikers.proto_ref_descriptor(F.concat(F.lit("..org."), F.lower("p_type"), F.lit("."), F.col("p_name"))).alias("proto"),
        monikers.k8s_symbol(
            F.when(F.col("p_size") % 4 > 0, F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise("")).otherwise(F.col("p_brand")),
            F.lit("Secret"), F.col("p_name"),
        ).alias("k8s"),
    )


@register("repo_of", f"""{sql.MERGED} SELECT doc_id, relative_path, split_part(relative_path, '/', 1) AS repo,
  CASE WHEN doc_id % 2 = 0 THEN 'x/' || relative_path ELSE relative_path END AS labelled, '<root>' AS bare FROM mdocs""")
def _(spark, folder):
    path = paths.prefix_path(F.col("source"), F.col("relative_path"))
    label = F.when(F.col("doc_id") % 2 == 0, "x").otherwise("")
    return starschema.order_documents(spark, folder).select("doc_id", path.alias("relative_path")).select(
        "doc_id", "relative_path", paths.repo_of(F.col("relative_path")).alias("repo"),
        paths.prefix_path(label, F.col("relative_path")).alias("labelled"),
        paths.repo_of(F.replace("relative_path", F.lit("/"), F.lit("_"))).alias("bare"),
    )


@register("render_location", f"""{sql.RAW} SELECT source, symbol_id, doc_id, start_line, CASE WHEN symbol_id % 3 = 0
  THEN 'f:' || CAST(start_line AS VARCHAR) || ':0' WHEN start_line = end_line THEN 'f:' || CAST(start_line AS VARCHAR)
  ELSE 'f:' || CAST(start_line AS VARCHAR) || '-' || CAST(end_line AS VARCHAR) END AS location FROM ranges""")
def _(spark, folder):
    char = F.when(F.col("symbol_id") % 3 == 0, F.col("start_char"))
    return raw_graph(spark, folder).definition_ranges.select(
        "source", "symbol_id", "doc_id", "start_line",
        ranges.render_location(F.lit("f"), F.col("start_line"), F.col("end_line"), char).alias("location"),
    )


@register("range_shapes", """SELECT DISTINCT l_orderkey, l_linenumber, n, CASE n WHEN 3 THEN 'a:1:a:2' WHEN 4 THEN 'a:1:b:2' END AS bounds,
  CASE WHEN n = 3 OR (n = 4 AND b = 0) THEN 'a:1:2' END AS token,
  CASE WHEN b = 0 THEN 7 ELSE 2 END AS lsp_end, n = 4 AND b < 0 AS bad
FROM (SELECT l_orderkey, l_linenumber, l_linenumber % 4 + 2 AS n, l_partkey % 3 - 1 AS b FROM lineitem)""")
def _(spark, folder):
    a, b = F.lit(10), F.lit(10) + (F.col("l_partkey") % 3 - 1).cast("int")
    n = (F.col("l_linenumber") % 4 + 2).cast("int")
    rng = F.when(n == 3, F.array(a, F.lit(1), F.lit(2))).when(n == 4, F.array(a, F.lit(1), b, F.lit(2))).when(
        n == 2, F.array(a, b),
    )
    bounds, token = ranges.normalise_range(rng), ranges.span_to_range(rng)
    shown = lambda s: F.when(s.isNotNull(), F.concat_ws(
        ":", F.lit("a"), s["start_char"], F.when(s["end_line"] == s["start_line"], F.when(n == 3, "a").otherwise("b")).otherwise("b"),
        s["end_char"],
    ))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", n.alias("n"), shown(bounds).alias("bounds"),
        F.when(token.isNotNull(), F.concat_ws(":", F.lit("a"), token["start_char"], token["end_char"])).alias("token"),
        ranges.lsp_range(a, F.lit(1), b, F.lit(7)).alias("lsp_end"), ranges.invalid_enclosing_range(rng).alias("bad"),
    ).distinct()


@register("uri_paths", """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'a b/x+' || k || '.tf' WHEN 1 THEN k || '.tf' WHEN 2 THEN NULL
  WHEN 3 THEN '.' ELSE 'c/' || k || '.tf' END AS relative_path FROM (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS k FROM orders)""")
def _(spark, folder):
    k = F.col("o_orderkey").cast("string")
    uri = (
        F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("file:///work/space/a%20b/x+"), k, F.lit(".tf")))
        .when(F.col("o_orderkey") % 5 == 1, F.concat(F.lit("file:///work/spaceship/"), k, F.lit(".tf")))
        .when(F.col("o_orderkey") % 5 == 2, F.concat(F.lit("https://host/"), k))
        .when(F.col("o_orderkey") % 5 == 3, F.lit("file:///work/./space/sub/.."))
        .otherwise(F.concat(F.lit("file://localhost/work/space/b/../c//"), k, F.lit(".tf?line=3#L1")))
    )
    return table(spark, folder, "orders").select(
        "o_orderkey", paths.relative_to_root(paths.uri_to_path(uri), "/work/space/").alias("relative_path"),
    )


@register("workspace_paths", """SELECT o_orderkey, o_orderkey % 6 IN (0, 3, 5) AS inside FROM orders""")
def _(spark, folder):
    k = F.col("o_orderkey").cast("string")
    shapes = ["src/", "../", "/etc/", "a/../b/./", "a/../../b/", "./..x/"]
    prefix = F.element_at(F.array(*[F.lit(s) for s in shapes]), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return table(spark, folder, "orders").select(
        "o_orderkey", paths.path_inside_workspace(F.concat(prefix, k)).alias("inside"),
    )


@register("source_lines", """SELECT source, file, CAST(n - 1 AS INTEGER) AS line_no, parts[n] AS line FROM (
  SELECT source, file, parts, unnest(range(1, len(parts) + 1)) AS n FROM (
    SELECT 'repo-' || CAST(o_custkey % 5 AS VARCHAR) AS source, lang || '/doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS file,
      string_split(CASE WHEN text LIKE '%' || chr(10) THEN left(text, length(text) - 1) ELSE text END, chr(10)) AS parts
    FROM documents JOIN orders ON o_orderkey = doc_id WHERE text <> ''))""")
def _(spark, folder):
    return source_lines(text_files(spark, folder))


_TOKENS = ("the", "un", "eau", "ing")


@register("token_hits", "SELECT doc_id, " + " + ".join(
    f"CAST(regexp_matches(t, '(^|[^a-z0-9]){token}') AS INTEGER)" for token in _TOKENS
) + " AS hits FROM (SELECT doc_id, lower(text) AS t FROM documents)")
def _(spark, folder):
    return table(spark, folder, "documents").select("doc_id", events.token_hits(F.lower("text"), _TOKENS).alias("hits"))


@register("recognizers", """SELECT event_id,
  CASE event_id % 4 WHEN 0 THEN event_type || ',poll' WHEN 3 THEN ''
    ELSE 'unmarshal,decode,deserialize,subscribe,consume,handle,handler,onmessage,process,receive,listener,callback' END AS consume,
  'marshal,encode,serialize,publish,emit,produce,dispatch,send,enqueue' AS produce FROM events""")
def _(spark, folder):
    kind = F.col("event_id") % 4
    raw = (
        F.when(kind == 0, F.concat(F.lit('{"consume": ["'), F.upper("event_type"), F.lit('", "poll"]}')))
        .when(kind == 1, F.col("props")).when(kind == 2, F.concat(F.lit('{"consume": ["a", 1], "produce": "'), F.col("event_type"), F.lit('"}')))
        .otherwise('{"consume": []}')
    )
    return table(spark, folder, "events").select("event_id", events.recognizers_from_json(raw).alias("r")).select(
        "event_id", F.array_join("r.consume", ",").alias("consume"), F.array_join("r.produce", ",").alias("produce"),
    )


@register("mention_roles", f"""{sql.RAW} SELECT role, count(*) AS n, count(*) FILTER (WHERE role <> 0 AND (role & 1) = 0) AS n_strict,
  count(*) FILTER (WHERE (role & 1) = 0) AS n_scip, count(*) FILTER (WHERE role <> 0) AS n_any, count(*) FILTER (WHERE role = 1) AS n_definition,
  count(*) FILTER (WHERE (role & 1) = 1) AS n_definition_bit FROM mentions GROUP BY role""")
def _(spark, folder):
    role = F.col("role")
    return raw_graph(spark, folder).mentions.groupBy("role").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(roles.is_reference_role(role)).alias("n_strict"),
        F.count_if(roles.is_reference_role(role, "scip")).alias("n_scip"), F.count_if(roles.is_mention_role(role)).alias("n_any"),
        F.count_if(roles.is_definition_role(role)).alias("n_definition"),
        F.count_if(roles.is_definition_role(role, bitwise=True)).alias("n_definition_bit"),
    )


@register("line_windows", """SELECT l_orderkey, l_linenumber, l_partkey, greatest(0, least(l_partkey - 5, 10)) AS context,
  greatest(0, s - 4) AS first_line, least(59, s + 9) AS last_line,
  CASE WHEN l_partkey % 200 + 1 > 120 THEN s + 119 ELSE s + l_partkey % 200 END AS body_end, l_partkey % 200 + 1 > 120 AS truncated
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, (l_linenumber - 1) * 10 AS s FROM lineitem)""")
def _(spark, folder):
    start = (F.col("l_linenumber") - 1) * 10
    window = ranges.clamp_window(start - 4, start + 9, F.lit(60))
    body = ranges.body_span(start, start + F.col("l_partkey") % 200)
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").distinct().select(
        "l_orderkey", "l_linenumber", "l_partkey", ranges.clamp_context(F.col("l_partkey") - 5).alias("context"),
        window["first_line"].alias("first_line"), window["last_line"].alias("last_line"),
        body["last_line"].alias("body_end"), body["truncated"].alias("truncated"),
    )


@register("scope_prefixes", f"""{sql.RAW} SELECT doc_id, relative_path ILIKE 'PUBLISHER%' AS plain, relative_path ILIKE 'pkg/order_1%' AS wild,
  relative_path ILIKE 'pkg/%' AS bounded FROM docs""")
def _(spark, folder):
    path = F.col("relative_path")
    return starschema.order_documents(spark, folder).select(
        "doc_id", text.path_prefix(path, F.lit("PUBLISHER/")).alias("plain"),
        text.path_prefix(path, F.lit("pkg/order_1")).alias("wild"), text.path_prefix(path, F.lit("pkg"), boundary=True).alias("bounded"),
    )
