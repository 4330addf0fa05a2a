"""Snapshots and file listings."""

from pyspark.sql import functions as F

from ..constants import MAX_RENDER_ROOTS
from ..constants import LANGUAGES
from ..sources import listing, snapshots, star_inputs
from .inputs import table
from .registry import register

_MARKERS = "[" + ", ".join(f"'{m}'" for m in star_inputs.MARKERS) + "]"
_LANG = """CASE o_orderkey % 9 WHEN 0 THEN 'typescript' WHEN 1 THEN 'go' WHEN 2 THEN 'python' WHEN 3 THEN 'rust' WHEN 4 THEN 'java'
  WHEN 5 THEN 'terraform' WHEN 6 THEN 'kubernetes' WHEN 7 THEN 'protobuf' END"""


@register("detect_languages", f"""SELECT repo, string_agg(language, ',' ORDER BY language) AS languages FROM (
  SELECT DISTINCT 'team/repo-' || CAST(o_custkey AS VARCHAR) AS repo, {_LANG} AS language FROM orders)
WHERE language IS NOT NULL GROUP BY repo""")
def _(spark, folder):
    found = listing.detect_languages(star_inputs.file_listing(spark, folder))
    return found.withColumn("languages", F.array_join("languages", ","))


_CHOICE = "CASE o_orderkey % 4 WHEN 0 THEN ' Go, PYTHON' WHEN 1 THEN lower(o_orderpriority) || ',rust' WHEN 2 THEN 'cobol,,' ELSE '' END"


def _selections(spark, folder):
    key = F.col("o_orderkey")
    langs = (
        F.when(key % 4 == 0, " Go, PYTHON").when(key % 4 == 1, F.concat(F.lower("o_orderpriority"), F.lit(",rust")))
        .when(key % 4 == 2, "cobol,,").otherwise("")
    )
    return table(spark, folder, "orders").select(key.alias("selection_id"), langs.alias("langs"))


_ALL = ", ".join(f"('{name}')" for name in LANGUAGES)


@register("select_languages", f"""SELECT o_orderkey AS selection_id, language FROM orders, (VALUES {_ALL}) known(language)
WHERE CASE o_orderkey % 4 WHEN 0 THEN language IN ('go', 'python') WHEN 1 THEN language = 'rust' ELSE true END""")
def _(spark, folder):
    return listing.select_languages(_selections(spark, folder))


@register("unknown_languages", """SELECT o_orderkey AS selection_id,
  CASE o_orderkey % 4 WHEN 1 THEN lower(o_orderpriority) ELSE 'cobol' END AS language FROM orders WHERE o_orderkey % 4 IN (1, 2)""")
def _(spark, folder):
    return listing.unknown_languages(_selections(spark, folder))


@register("target_subdirs", """SELECT scan_id, subdir, position FROM (
  SELECT o_custkey AS scan_id, coalesce(CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus END, '') AS subdir,
    min(o_orderkey) AS position FROM orders WHERE o_orderpriority < '3' GROUP BY ALL)
UNION ALL SELECT o_custkey, '', 0 FROM orders GROUP BY o_custkey HAVING min(o_orderpriority) >= '3'""")
def _(spark, folder):
    kind = F.when(F.startswith("o_orderpriority", F.lit("1")), "repository").when(
        F.startswith("o_orderpriority", F.lit("2")), "local_code").otherwise("web")
    targets = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("scan_id"), F.col("o_orderkey").alias("position"), kind.alias("type"),
        F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderstatus")).alias("workspace_subdir"),
    )
    return listing.target_subdirs(targets)


_FOLDERS = """WITH f AS (SELECT 'repo-' || CAST(o_custkey % 50 AS VARCHAR) AS repo, 'env/' || o_orderstatus || '/app-' ||
  CAST(o_orderkey AS VARCHAR) AS root, o_orderkey AS k, o_orderpriority LIKE '1%' AS remote FROM orders)"""


@register("render_roots", f"""{_FOLDERS}, roots AS (
  SELECT repo, root, 'kustomize' AS kind FROM f WHERE k % 3 < 2 AND NOT remote
  UNION ALL SELECT repo, root, 'helm' FROM f WHERE k % 2 = 0 AND k % 5 > 0 AND k % 3 = 2)
SELECT * FROM (SELECT repo, root, kind, CAST(row_number() OVER (PARTITION BY repo ORDER BY kind DESC, string_split(root, '/')) AS INTEGER)
  AS position FROM roots) WHERE position <= 40""")
def _(spark, folder):
    return listing.render_roots(star_inputs.deployment_listing(spark, folder), cap=MAX_RENDER_ROOTS)


@register("render_roots_all", f"""{_FOLDERS}, roots AS (
  SELECT repo, root, 'kustomize' AS kind FROM f WHERE k % 3 < 2 AND NOT remote
  UNION ALL SELECT repo, root, 'helm' FROM f WHERE k % 2 = 0 AND k % 5 > 0 AND k % 3 = 2)
SELECT repo, root, kind FROM roots""")
def _(spark, folder):
    return listing.render_roots(star_inputs.deployment_listing(spark, folder))


@register("proto_roots", f"""{_FOLDERS}, c AS (
  SELECT repo, '' AS root, 0 AS d, 1 AS r FROM f WHERE k % 997 = 0
  UNION ALL SELECT repo, root || '/proto', 1, 0 FROM f WHERE k % 11 = 0
  UNION ALL SELECT repo, root, 1, 1 FROM f WHERE k % 7 = 0)
SELECT repo, root FROM (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY d, r, string_split(root, '/')) AS n FROM c) WHERE n = 1""")
def _(spark, folder):
    return listing.proto_roots(star_inputs.deployment_listing(spark, folder))


_KEYS = """WITH k AS (SELECT 'team/repo-' || CAST(o_custkey AS VARCHAR) AS repo, CASE WHEN o_orderstatus = 'P'
  THEN 'ab' || CAST(o_orderkey AS VARCHAR) ELSE md5(CAST(o_orderkey AS VARCHAR)) END AS head_sha, o_orderdate AS modified,
  o_orderpriority AS p FROM orders)"""


@register("plan_rebuild", f"{_KEYS} SELECT repo, head_sha FROM k WHERE p LIKE '1%'")
def _(spark, folder):
    return snapshots.plan_rebuild(*star_inputs.snapshot_tables(spark, folder))


@register("snapshot_hits", f"{_KEYS} SELECT repo, head_sha FROM k WHERE p NOT LIKE '1%'")
def _(spark, folder):
    return snapshots.snapshot_hits(*star_inputs.snapshot_tables(spark, folder))


@register("accepted_snapshot_keys", f"{_KEYS} SELECT repo, head_sha, repo || '/' || head_sha AS path FROM k WHERE length(head_sha) >= 7")
def _(spark, folder):
    return snapshots.accepted_keys(star_inputs.snapshot_tables(spark, folder)[0])


@register("rejected_snapshot_keys", f"{_KEYS} SELECT repo, head_sha FROM k WHERE length(head_sha) < 7")
def _(spark, folder):
    return snapshots.rejected_keys(star_inputs.snapshot_tables(spark, folder)[0])


@register("latest_snapshot", f"""{_KEYS} SELECT repo, path FROM (SELECT repo, repo || '/' || head_sha AS path,
  row_number() OVER (PARTITION BY repo ORDER BY modified DESC, repo || '/' || head_sha DESC) AS n FROM k WHERE p NOT LIKE '1%')
WHERE n = 1""")
def _(spark, folder):
    return snapshots.latest_snapshot(star_inputs.snapshot_tables(spark, folder)[1], ["repo"]).select("repo", "path")


@register("adopt_corpus", f"""{_KEYS}, corpus AS (SELECT DISTINCT repo FROM k WHERE p LIKE '1%'), session AS (
  SELECT DISTINCT repo FROM k WHERE p LIKE '2%')
SELECT a.repo, coalesce('corpus/' || c.repo, 'session/' || s.repo) AS path, c.repo IS NOT NULL AS adopted
FROM (SELECT DISTINCT repo FROM k) a LEFT JOIN corpus c ON c.repo = a.repo LEFT JOIN session s ON s.repo = a.repo""")
def _(spark, folder):
    repo = F.concat(F.lit("team/repo-"), F.col("o_custkey").cast("string")).alias("repo")
    orders = table(spark, folder, "orders")
    stored = lambda digit, where: orders.filter(F.startswith("o_orderpriority", F.lit(digit))).select(repo).distinct().withColumn(
        "path", F.concat(F.lit(where), F.col("repo")),
    )
    return snapshots.adopt_corpus(orders.select(repo).distinct(), stored("1", "corpus/"), stored("2", "session/"))
