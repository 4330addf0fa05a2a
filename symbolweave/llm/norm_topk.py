"""Exact top-k inner products by norm buckets with coordinate or length pruning in each."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from symbolweave.llm.common import stored

SCALE, BLOCK, QUERY_BLOCK, BUCKETS = 1024.0, 4096, 512, 64
FOCUS, COORDINATE_FROM = 4, 0.25
_LIMIT = 2**63 - 1


def quantised(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """``vec_id, parts, norm, size`` of the vectors that take part: components ``floor(scale * x)`` as long."""
    parts = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long"))
    good = F.col("vec_id").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm = F.sqrt(F.aggregate("parts", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return vectors.where(good).select("vec_id", parts.alias("parts")).withColumn("norm", norm).withColumn("size", F.size("parts"))


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products; values beyond the range of long end at its limits."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if bound < 2**52:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    wide = queries.astype(object) @ rows.astype(object).T
    return np.clip(wide, -_LIMIT - 1, _LIMIT).astype(np.int64)


def search_block(queries: np.ndarray, least: np.ndarray, ids: np.ndarray, rows: np.ndarray, own: np.ndarray, k: int):
    """The ``k`` best rows of a block for each query, as ``(query position, row position, score)``.

    Rows come by falling length. For a query and the score to reach, the longest row gives the local cosine threshold:
    above one nothing can reach it; when it is high, rows are kept whose focus coordinates lie in the band that the
    threshold allows; else rows that are long enough. What is left is verified by exact products.
    """
    lengths = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))
    units = rows / np.where(lengths > 0, lengths, 1)[:, None]
    out = []
    for q in range(len(queries)):
        size = float(np.sqrt((queries[q].astype(np.float64) ** 2).sum()))
        reach = float(least[q])
        keep = np.ones(len(rows), dtype=bool)
        # Small slack keeps rounding from dropping a row; the products decide.
        if reach > 0:
            if size == 0 or reach > size * lengths[0] * (1 + 1e-9):
                continue
            cosine = reach / (size * lengths[0])
            if cosine >= COORDINATE_FROM:
                unit = queries[q] / size
                for f in np.argsort(-np.abs(unit))[:FOCUS]:
                    band = np.sqrt(max(0.0, (1 - cosine * cosine) * (1 - unit[f] * unit[f]))) + 1e-9
                    # The farther side is open: a cosine above the threshold may lie nearer to the query.
                    low = -1.0 if -unit[f] >= cosine else unit[f] * cosine - band
                    high = 1.0 if unit[f] >= cosine else unit[f] * cosine + band
                    keep &= (units[:, f] >= low - 1e-9) & (units[:, f] <= high + 1e-9)
            else:
                keep &= lengths * size >= reach * (1 - 1e-9)
        keep &= ids != own[q]
        at = np.flatnonzero(keep)
        if not len(at):
            continue
        scores = _products(queries[q : q + 1], rows[at])[0]
        best = np.lexsort((ids[at], -scores.astype(object) if scores.min() == -_LIMIT - 1 else -scores))[:k]
        out += [(q, at[i], scores[i]) for i in best if scores[i] >= reach]
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each of ``queries(vec_id)`` the ``k`` highest inner products.

    All rows are grouped by length into buckets, cut into blocks of about ``block`` rows. Queries first meet the
    bucket of the longest rows, whose k-th score becomes the score to reach; then only the blocks that can hold such a
    score. Vectors null or with null or non-finite components take no part, nor do rows with a null id; vectors of
    different lengths do not meet; an empty vector scores 0; ties go to the smaller id; rows with the query's id are
    its own and are left out; other repeated rows each count. A query with no other row gives no rows.
    """
    table = stored(quantised(vectors), "topk-vectors")
    total = table.count()
    cuts = table.agg(F.percentile_approx("norm", [i / BUCKETS for i in range(1, BUCKETS)], 10_000)).first()[0] if total else []
    edges = sorted(set(cuts or []))
    bucket = sum([(F.col("norm") > e).cast("int") for e in edges], F.lit(0)) if edges else F.lit(0)
    per = table.withColumn("bucket", bucket)
    sizes = per.groupBy("size", "bucket").agg(F.ceil(F.count("*") / block).cast("int").alias("subs"), F.max("norm").alias("longest"))
    tops = sizes.groupBy("size").agg(F.max("bucket").alias("top"))
    sizes = stored(sizes.join(tops, "size"), "topk-buckets")
    placed = per.join(sizes.select("size", "bucket", "subs"), ["size", "bucket"]).withColumn("sub", F.pmod(F.xxhash64("vec_id"), F.col("subs")).cast("int"))
    asked = table.join(queries.select(F.col("vec_id").alias("_q")).distinct(), F.col("vec_id") == F.col("_q"), "left_semi")
    asked = asked.select(F.col("vec_id").alias("query_id"), F.col("parts").alias("query"), F.col("norm").alias("query_norm"), "size").dropDuplicates(["query_id", "query"])
    groups = max(1, -(-asked.count() // QUERY_BLOCK))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int"))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    first = asked.withColumn("least", F.lit(float("-inf"))).join(sizes.where("bucket = top"), "size")
    seeds = stored(_meet(placed, first, groups, k), "topk-first")
    reached = seeds.withColumn("r", F.row_number().over(rank)).where(F.col("r") == k).select("query_id", F.col("score").cast("double").alias("least"))
    later = asked.join(reached, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    later = later.join(sizes.where("bucket < top"), "size").where("least <= 0 OR least <= query_norm * longest * (1 + 1e-9D)")
    found = seeds.union(_meet(placed, later, groups, k)).withColumn("rank", F.row_number().over(rank).cast("int")).where(F.col("rank") <= k)
    return found.select(F.col("query_id").cast("long").alias("query_id"), "rank", F.col("vec_id").cast("long").alias("vec_id"), "score")


def _meet(placed: DataFrame, asked: DataFrame, groups: int, k: int) -> DataFrame:
    """Blocks of queries meet blocks of rows, one task group for each two."""
    key = ["size", "bucket", "sub", "part"]
    left = placed.select("size", "bucket", "sub", "vec_id", "parts").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = asked.withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1))).select(*key, "query_id", "query", "least")

    def run(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        out = []
        if len(rows) and len(wanted):
            size = rows.column("size")[0].as_py()
            data = np.array(rows.column("parts").to_pylist(), dtype=np.int64).reshape(len(rows), size)
            order = np.argsort(-(data.astype(np.float64) ** 2).sum(axis=1), kind="stable")
            ids, data = np.array(rows.column("vec_id").to_pylist())[order], data[order]
            own = np.array(wanted.column("query_id").to_pylist())
            vectors = np.array(wanted.column("query").to_pylist(), dtype=np.int64).reshape(len(own), size)
            out = [(own[q].item(), ids[r].item(), int(s)) for q, r, s in search_block(vectors, np.array(wanted.column("least").to_pylist()), ids, data, own, k)]
        names = ("query_id", "vec_id", "score")
        return pa.table({n: pa.array([o[i] for o in out], pa.int64()) for i, n in enumerate(names)})

    left, right = left.toDF(*left.columns), right.toDF(*right.columns)
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "query_id bigint, vec_id bigint, score bigint")
