"""Occurrences from manifests, schemas and language servers, and the graph built from them."""

from pyspark.sql import functions as F

from ..functions import monikers
from ..operators import build, kubernetes, lookup, merge, protobuf, terraform
from ..sources import star_inputs
from ..sources.store import stored_once
from . import inputs, sql
from .registry import register

PER_CHUNK = 3


def _text(column):
    return F.array_join(F.transform(column, lambda n: n.cast("string")), ",")


def _flat(df):
    """Ranges as text, so that both engines print them alike."""
    return df.withColumn("range", _text(F.col("range"))).withColumn("enclosing_range", _text(F.col("enclosing_range")))


_OCCURRENCES = f"""{sql.RAW}, raw_occ AS (
  SELECT DISTINCT source, 'order_' || CAST(doc_id AS VARCHAR) || '.go' AS relative_path, symbol, role,
    CAST((l_linenumber - 1) * 20 + part_id % 20 AS INTEGER) AS line, CAST(part_id % 40 AS INTEGER) AS ch,
    CASE WHEN part_id % 2 = 0 THEN CAST(part_id % 7 - 1 AS INTEGER) END AS more FROM edges),
occ AS (SELECT *, CAST(line AS VARCHAR) || ',' || CAST(ch AS VARCHAR) || ',' || CAST(ch + 5 AS VARCHAR) AS range,
  more < 0 OR (more = 0 AND 1 < ch) AS bad,
  CAST(line AS VARCHAR) || ',' || CAST(ch AS VARCHAR) || ',' || CAST(line + more AS VARCHAR) || ',1' AS enclosing FROM raw_occ)"""


def _occurrences(spark, folder):
    return inputs.occurrences(spark, folder)


@register("clear_bad_ranges", f"""{_OCCURRENCES} SELECT source, relative_path, symbol, role, range,
  CASE WHEN NOT bad THEN enclosing END AS enclosing_range FROM occ""")
def _(spark, folder):
    return _flat(build.clear_bad_ranges(_occurrences(spark, folder)))


@register("bad_range_counts", f"{_OCCURRENCES} SELECT source, count(*) FILTER (WHERE bad) AS cleared FROM occ GROUP BY source")
def _(spark, folder):
    return build.bad_range_counts(_occurrences(spark, folder))


_MISSING = "SELECT DISTINCT source, relative_path, symbol FROM occ WHERE (role & 1) = 1 AND symbol LIKE 'local%'"


@register("add_missing_symbols", f"""{_OCCURRENCES} SELECT source, relative_path, symbol FROM ({_MISSING}
UNION ALL SELECT DISTINCT source, relative_path, symbol FROM occ WHERE symbol NOT LIKE 'local%')""")
def _(spark, folder):
    info = inputs.symbol_info(spark, folder)
    return build.add_missing_symbols(_occurrences(spark, folder), info).select("source", "relative_path", "symbol")


@register("missing_symbol_counts", f"{_OCCURRENCES} SELECT source, count(*) AS inserted FROM ({_MISSING}) GROUP BY source")
def _(spark, folder):
    return build.missing_symbol_counts(_occurrences(spark, folder), inputs.symbol_info(spark, folder))


@register("defined_symbols", f"{_OCCURRENCES} SELECT DISTINCT source, relative_path, symbol FROM occ WHERE (role & 1) = 1")
def _(spark, folder):
    return build.defined_symbols(_occurrences(spark, folder))


@register("non_empty_documents", f"""{_OCCURRENCES} SELECT source, doc_id FROM docs d WHERE EXISTS (
  SELECT 1 FROM occ o WHERE o.source = d.source AND o.relative_path = 'order_' || CAST(d.doc_id AS VARCHAR) || '.go')""")
def _(spark, folder):
    orders = star_inputs.table(spark, folder, "orders")
    listed = orders.select(
        star_inputs.repository().alias("source"), F.col("o_orderkey").alias("doc_id"),
        F.concat(F.lit("order_"), F.col("o_orderkey").cast("string"), F.lit(".go")).alias("relative_path"),
    )
    return build.non_empty_documents(listed, _occurrences(spark, folder)).select("source", "doc_id")


_CHUNKED = f"""{_OCCURRENCES}, chunked AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY source, relative_path
  ORDER BY line, ch, line, ch + 5, symbol, role) - 1) / {PER_CHUNK}) AS INTEGER) AS chunk_index FROM occ)"""


@register("build_graph_chunks", f"""{_CHUNKED} SELECT source, relative_path, chunk_index, min(line) AS start_line, max(line) AS end_line
FROM chunked GROUP BY source, relative_path, chunk_index""")
def _(spark, folder):
    graph = _built(spark, folder)
    return graph.chunks.join(graph.documents.select("source", "doc_id", "relative_path"), ["source", "doc_id"]).select(
        "source", "relative_path", "chunk_index", "start_line", "end_line",
    )


def _built(spark, folder):
    return build.build_graph(
        _occurrences(spark, folder), inputs.symbol_info(spark, folder), per_chunk=PER_CHUNK,
    )


@register("build_graph_mentions", f"SELECT DISTINCT * FROM ({_CHUNKED} SELECT source, relative_path, chunk_index, symbol, role FROM chunked)")
def _(spark, folder):
    graph = _built(spark, folder)
    return (
        graph.mentions.join(graph.chunks.select("source", "chunk_id", "doc_id", "chunk_index"), ["source", "chunk_id"])
        .join(graph.documents.select("source", "doc_id", "relative_path"), ["source", "doc_id"])
        .join(graph.symbols.select("symbol_source", "symbol_id", "symbol"), ["symbol_source", "symbol_id"])
        .select("source", "relative_path", "chunk_index", "symbol", "role")
    )


@register("build_graph_ranges", f"""{_OCCURRENCES} SELECT DISTINCT source, relative_path, symbol, line AS start_line, ch AS start_char,
  line + more AS end_line, 1 AS end_char FROM occ WHERE (role & 1) = 1 AND NOT bad""")
def _(spark, folder):
    graph = _built(spark, folder)
    return (
        graph.definition_ranges.join(graph.documents.select("source", "doc_id", "relative_path"), ["source", "doc_id"])
        .join(graph.symbols.select("symbol_source", "symbol_id", "symbol"), ["symbol_source", "symbol_id"])
        .select("source", "relative_path", "symbol", "start_line", "start_char", "end_line", "end_char")
    )


@register("build_graph_symbols", f"{_OCCURRENCES} SELECT DISTINCT source, symbol FROM occ")
def _(spark, folder):
    return _built(spark, folder).symbols.select(F.col("symbol_source").alias("source"), "symbol")


# --- Kubernetes -------------------------------------------------------------------------

_NS = "CASE WHEN {0} % 3 > 0 THEN 'ns-' || CAST({0} % 3 AS VARCHAR) ELSE 'default' END"
_K8S = f"""WITH kinds AS (SELECT *, {sql.REPO} AS source, 'deploy/batch-' || CAST(floor(o_orderkey / 100)::BIGINT AS VARCHAR) AS root,
  ['Deployment', 'CronJob', 'Pod', 'RoleBinding', 'Ingress', 'StatefulSet'][CAST(o_orderkey % 6 + 1 AS INTEGER)] AS kind,
  {_NS.format('o_custkey')} AS ns FROM orders WHERE o_orderpriority NOT LIKE '5%'),
work AS (SELECT *, CAST(row_number() OVER (PARTITION BY source, root ORDER BY o_orderkey) - 1 AS INTEGER) AS line FROM kinds),
secrets AS (SELECT 'repo-' || CAST(p_partkey % 5 AS VARCHAR) AS source, 'secrets' AS root,
  CAST(row_number() OVER (PARTITION BY p_partkey % 5 ORDER BY p_partkey) - 1 AS INTEGER) AS line,
  {_NS.format('p_size')} || '/Secret/secret-' || CAST(p_partkey AS VARCHAR) AS name FROM part),
accounts AS (SELECT 'repo-' || CAST(c_custkey % 5 AS VARCHAR) AS source, '.' AS root,
  CAST(row_number() OVER (PARTITION BY c_custkey % 5 ORDER BY c_custkey) - 1 AS INTEGER) AS line,
  {_NS.format('c_custkey')} || '/ServiceAccount/account-' || CAST(c_custkey AS VARCHAR) AS name FROM customer),
defs AS (
  SELECT source, root, line, name FROM secrets UNION ALL SELECT source, root, line, name FROM accounts
  UNION ALL SELECT source, root, line, ns || '/' || kind || '/app-' || CAST(o_orderkey AS VARCHAR) FROM work),
refs AS (
  SELECT source, root, line, ns || '/ServiceAccount/account-' || CAST(o_custkey AS VARCHAR) AS name FROM work
  WHERE kind <> 'Ingress'
  UNION ALL SELECT source, root, line, ns || '/Secret/secret-' || CAST(l_partkey AS VARCHAR)
  FROM work JOIN lineitem ON l_orderkey = o_orderkey WHERE kind NOT IN ('Ingress', 'RoleBinding')),
occ AS (
  SELECT source, root, line, name, 1 AS role FROM defs
  UNION ALL SELECT source, root, line, name, 0 FROM refs r WHERE EXISTS (
    SELECT 1 FROM defs d WHERE d.source = r.source AND d.name = r.name))"""


@register("k8s_occurrences", f"""{_K8S} SELECT source, root || '/__rendered__.yaml' AS relative_path,
  'scip-k8s . . . ' || name || '#' AS symbol, role, CAST(line AS VARCHAR) || ',0,0' AS range, CAST(NULL AS VARCHAR) AS enclosing_range
FROM occ""")
def _(spark, folder):
    return _flat(kubernetes.k8s_occurrences(inputs.k8s_objects(spark, folder)))


@register("k8s_references", f"""{_K8S} SELECT source, 'scip-k8s . . . ' || name || '#' AS symbol, count(*) AS n
FROM refs GROUP BY source, name""")
def _(spark, folder):
    return kubernetes.object_references(inputs.k8s_objects(spark, folder)).groupBy("source", "symbol").agg(F.count(F.lit(1)).alias("n"))


_ACCESS = f"""WITH o AS (SELECT *, {sql.REPO} AS source, o_orderkey % 8 AS nth, {_NS.format('o_custkey')} AS ns,
  CAST(o_custkey AS VARCHAR) AS c FROM orders),
refs AS (
  SELECT source, CASE WHEN nth IN (1, 2) THEN 'default/ClusterRole/role-' ELSE ns || '/Role/role-' END || c AS name
  FROM o WHERE nth < 4 AND o_orderkey % 24 <> 0
  UNION ALL SELECT source, ns || '/Service/service-' || CAST(l_suppkey AS VARCHAR) FROM o JOIN lineitem ON l_orderkey = o_orderkey WHERE nth = 4
  UNION ALL SELECT source, ns || '/Service/fallback' FROM o WHERE o_orderkey % 16 = 4
  UNION ALL SELECT source, ns || '/ServiceAccount/account-' || c FROM o WHERE nth >= 5)"""


@register("k8s_access_references", f"""{_ACCESS} SELECT source, 'scip-k8s . . . ' || name || '#' AS symbol, count(*) AS n
FROM refs GROUP BY source, name""")
def _(spark, folder):
    found = kubernetes.object_references(star_inputs.access_objects(spark, folder))
    return found.groupBy("source", "symbol").agg(F.count(F.lit(1)).alias("n"))


# --- Protobuf ---------------------------------------------------------------------------

_PROTO = f"""{sql.RAW}, msgs AS (SELECT DISTINCT source, 'api/order_' || CAST(doc_id AS VARCHAR) || '.proto' AS relative_path,
  'shop/v1/Line' || CAST(l_linenumber AS VARCHAR) AS m, 'shop/v1/Svc' || CAST(l_linenumber AS VARCHAR) AS svc,
  (l_linenumber - 1) * 20 AS base FROM edges),
decl(suffix, depth, step, role, width) AS (VALUES
  ('#', 2, 1, 1, 9), ('#state.', 4, 1, 1, 9), ('#note.', 4, 1, 1, 9), ('/Detail#', 4, 1, 1, 9), ('/Detail#parent.', 6, 1, 1, 9),
  ('/Detail/State#', 6, 1, 1, 5), ('/Detail/State#READY.', 8, 1, 1, 9),
  ('/Detail/State#', 4, 6, 0, 9), ('#', 6, 6, 0, 9), ('#', 4, 2, 0, 9), ('/Detail#', 4, 3, 0, 9)),
occ AS (
  SELECT source, relative_path, m || suffix AS d, role, base + depth AS line, step, width FROM msgs, decl
  UNION ALL SELECT source, relative_path, svc || '#Get().', 1, base + 4, 1, 9 FROM msgs)"""


@register("proto_occurrences", f"""{_PROTO} SELECT source, relative_path, 'scip-proto proto . . ' || d AS symbol, role,
  CAST(line AS VARCHAR) || ',' || CAST(step AS VARCHAR) || ',' || CAST(step + width AS VARCHAR) AS range,
  CAST(NULL AS VARCHAR) AS enclosing_range FROM occ""")
def _(spark, folder):
    return _flat(protobuf.proto_occurrences(*inputs.proto_tables(spark, folder)))


@register("proto_file_enums", f"""{sql.RAW}, f AS (SELECT DISTINCT source, 'enums/order_' || CAST(doc_id AS VARCHAR) || '.proto' AS relative_path,
  l_linenumber AS n, CAST((l_linenumber - 1) * 20 AS INTEGER) AS base FROM edges),
decl(d, tail, role, line, step) AS (VALUES
  ('Mode', '#', 1, 17, 1), ('Mode', '#ON.', 1, 19, 1), ('Line', '#', 1, 14, 1), ('Line', '#mode.', 1, 16, 1), ('Mode', '#', 0, 16, 6))
SELECT source, relative_path, 'scip-proto proto . . ' || d || CAST(n AS VARCHAR) || tail AS symbol, role,
  CAST(base + line AS VARCHAR) || ',' || CAST(step AS VARCHAR) || ',' || CAST(step + 4 AS VARCHAR) AS range,
  CAST(NULL AS VARCHAR) AS enclosing_range FROM f, decl""")
def _(spark, folder):
    return _flat(protobuf.proto_occurrences(*star_inputs.enum_tables(inputs.edges(spark, folder))))


# --- Terraform --------------------------------------------------------------------------

_TF = f"""{sql.RAW}, lines AS (SELECT source, doc_id, l_linenumber AS n, min(part_id) AS part_id FROM edges GROUP BY ALL),
named AS (SELECT *, 'resource/item/p' || CAST(part_id AS VARCHAR) || ['#', '#', '.', '.', '/'][CAST(n % 5 + 1 AS INTEGER)] AS d,
  'mod a/order_' || CAST(doc_id AS VARCHAR) || '.tf' AS path FROM lines),
occ AS (
  SELECT source, path AS relative_path, d, 1 AS role, n * 10 AS line, 0 AS a, 8 AS b FROM named
  UNION ALL SELECT source, path, 'attribute/size.', 1, n * 10 + 1, 2, 6 FROM named
  UNION ALL SELECT source, CASE WHEN n = 6 THEN 'shared_' || CAST(doc_id AS VARCHAR) || '.tf'
    ELSE 'mod a/order_' || CAST(doc_id + 1 AS VARCHAR) || '.tf' END, d, 0, n * 10 + 3, 4, 12 FROM named WHERE n <> 7)"""


@register("terraform_occurrences", f"""{_TF} SELECT source, relative_path, 'scip-terraform . . . ' || d AS symbol, role,
  CAST(line AS VARCHAR) || ',' || CAST(a AS VARCHAR) || ',' || CAST(b AS VARCHAR) AS range, CAST(NULL AS VARCHAR) AS enclosing_range FROM occ""")
def _(spark, folder):
    responses, references = inputs.terraform_tables(spark, folder)
    return _flat(terraform.terraform_occurrences(responses, references, star_inputs.TERRAFORM_ROOT))


@register("terraform_documents", f"""{_TF} SELECT DISTINCT source, relative_path, 'terraform' AS language FROM occ""")
def _(spark, folder):
    responses, references = inputs.terraform_tables(spark, folder)
    occurrences = terraform.terraform_occurrences(responses, references, star_inputs.TERRAFORM_ROOT)
    return terraform.terraform_documents(responses, occurrences, star_inputs.TERRAFORM_ROOT)


@register("terraform_nested", f"""WITH o AS (SELECT *, {sql.REPO} AS source,
  CASE WHEN o_orderkey % 1000 = 0 THEN 200 ELSE o_orderkey % 14 + 1 END AS depth FROM orders),
levels AS (SELECT source, o_orderkey, depth, unnest(range(1, depth + 1)) AS i FROM o)
SELECT source, 'deep/order_' || CAST(o_orderkey AS VARCHAR) || '.tf' AS relative_path,
  'scip-terraform . . . attribute/n' || CAST(i AS VARCHAR) || '.' AS symbol,
  CAST(CASE WHEN i = depth AND o_orderkey % 2 = 0 THEN i + 500 ELSE i END AS INTEGER) AS line, 0 AS character, 1 AS end_character FROM levels""")
def _(spark, folder):
    found = terraform.terraform_definitions(star_inputs.nested_responses(spark, folder), star_inputs.TERRAFORM_ROOT)
    return found.select("source", "relative_path", "symbol", "line", "character", "end_character")


# --- From manifests, schemas and server results to answers --------------------------------


def _answered(spark, name, occurrences):
    """References of every name of the merged, stored graph of some occurrences."""
    graph = stored_once(
        spark, name, lambda: merge.merge_sources(build.build_graph(occurrences(), per_chunk=PER_CHUNK, shared=True)), site_buckets=inputs.TEST_BUCKETS,
    )
    shown = graph.named_symbols().select(F.col("display_name").alias("query_id"), F.col("display_name").alias("name")).distinct()
    found = lookup.find_references(graph, shown, match="exact", role_policy="scip")
    return found.select("query_id", "symbol", "source", "file", "start_line", "end_line", "role")


def _answered_sql(base, path, symbol, stored, line, start, end):
    return f"""{base}, placed AS (SELECT source, {path} AS path, {symbol} AS symbol, role, CAST({line} AS INTEGER) AS line,
  CAST(floor((row_number() OVER (PARTITION BY source, {path} ORDER BY {line}, {start}, {end}, {symbol}, role) - 1) / {PER_CHUNK}) AS INTEGER) AS ci FROM occ),
spans AS (SELECT source, path, ci, min(line) AS start_line, max(line) AS end_line FROM placed GROUP BY ALL)
SELECT DISTINCT {sql.display('p.symbol')} AS query_id, {stored} AS symbol, p.source, p.source || '/' || p.path AS file, s.start_line, s.end_line, p.role
FROM placed p JOIN spans s USING (source, path, ci) WHERE (p.role & 1) = 0"""


@register("k8s_graph_references", _answered_sql(
    _K8S, "root || '/__rendered__.yaml'", "'scip-k8s . . . ' || name || '#'", "p.source || '/' || p.symbol", "line", "0", "0"))
def _(spark, folder):
    return _answered(spark, f"k8s-graph{folder}", lambda: kubernetes.k8s_occurrences(inputs.k8s_objects(spark, folder)))


@register("proto_graph_references", _answered_sql(
    _PROTO, "relative_path", "'scip-proto proto . . ' || d", "p.symbol", "line", "step", "step + width"))
def _(spark, folder):
    return _answered(spark, f"proto-graph{folder}", lambda: protobuf.proto_occurrences(*inputs.proto_tables(spark, folder)))


@register("terraform_graph_references", _answered_sql(
    _TF, "relative_path", "'scip-terraform . . . ' || d", "p.source || '/' || p.symbol", "line", "a", "b"))
def _(spark, folder):
    responses, references = inputs.terraform_tables(spark, folder)
    return _answered(spark, f"terraform-graph{folder}",
                     lambda: terraform.terraform_occurrences(responses, references, star_inputs.TERRAFORM_ROOT))


@register("known_definitions", f"""{_K8S} SELECT DISTINCT source, 'scip-k8s . . . ' || name || '#' AS symbol FROM defs""")
def _(spark, folder):
    return kubernetes.object_definitions(inputs.k8s_objects(spark, folder)).distinct()


@register("package_symbol_counts", f"""{_PROTO} SELECT 'scip-proto' AS scheme, 'proto' AS manager, count(*) AS n FROM occ""")
def _(spark, folder):
    symbols = protobuf.proto_occurrences(*inputs.proto_tables(spark, folder)).filter(
        monikers.is_package_symbol(F.col("symbol")),
    ).select(monikers.moniker_parts(F.col("symbol")).alias("p"))
    return symbols.groupBy("p.scheme", "p.manager").agg(F.count(F.lit(1)).alias("n"))
