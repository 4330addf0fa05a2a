"""Near-duplicate vectors: binary codes by iterative quantisation, multi-index Hamming tables, reranking with the vectors."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from symbolweave.llm.common import stored
from symbolweave.llm.components import components

SAMPLE, ROTATIONS, STEPS = 8192, 3, 30
TABLES, WIDTH, BLOCK = 16, 12, 1024


def learn_rotation(sample: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection whose signs are balanced binary codes of unit vectors like the sample's rows."""
    dim = sample.shape[1]
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred + 1e-12 * np.eye(dim))
    spread = centred @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    for _ in range(STEPS):
        signs = np.where(spread @ turn >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(spread.T @ signs)
        turn = u @ v
    return mean, axes @ turn


def _unit(vector) -> np.ndarray | None:
    """The vector at length one, or None if it is null, empty, zero or holds a null or non-finite component."""
    if not vector or None in vector:
        return None
    x = np.asarray(vector, dtype=np.float64)
    top = np.abs(x).max()
    if not np.isfinite(top) or top == 0:
        return None
    x = x / top
    return x / np.sqrt(x @ x) + 0.0


def fit(vectors: DataFrame, sample: int = SAMPLE) -> dict:
    """Rotations per vector length, learnt from the ``sample`` vectors with the smallest hashed ids."""
    rows = vectors.select("vec_id", "embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    by_length: dict[int, list] = {}
    for row in rows:
        x = _unit(row["embedding"])
        if x is not None:
            by_length.setdefault(len(x), []).append(x)
    return {dim: [learn_rotation(np.array(xs), seed) for seed in range(ROTATIONS)] for dim, xs in by_length.items()}


def keys_of(x: np.ndarray, model: dict, tables: int, width: int) -> np.ndarray:
    """Substrings of each vector's code, one for each table. A length the sample lacks gets seeded random rotations."""
    dim = x.shape[1]
    rotations = model.get(dim)
    if rotations is None:
        rotations = [(np.zeros(dim), np.linalg.qr(np.random.default_rng(s).standard_normal((dim, dim)))[0]) for s in range(ROTATIONS)]
    bits = np.concatenate([(x - mean) @ turn >= 0 for mean, turn in rotations], axis=1)
    out = np.zeros((len(x), tables), dtype=np.int32)
    for t in range(tables):
        for k in range(width):
            out[:, t] |= bits[:, (t * width + k) % bits.shape[1]].astype(np.int32) << k
    return out


def _code(vectors: DataFrame, model: dict, tables: int, width: int) -> DataFrame:
    """``vec_id, label, digest, unit, keys``; the last three are null for vectors that link with nothing."""
    def run(batches):
        for batch in batches:
            ids, labels, embeddings = batch.columns
            units = [None if label is None else _unit(v) for v, label in zip(embeddings.to_pylist(), labels.to_pylist())]
            keys: list = [None] * len(units)
            for dim in {len(u) for u in units if u is not None}:
                at = [i for i, u in enumerate(units) if u is not None and len(u) == dim]
                for i, k in zip(at, keys_of(np.array([units[i] for i in at]), model, tables, width)):
                    keys[i] = k.tolist()
            raw = [None if u is None else u.tobytes() for u in units]
            yield pa.RecordBatch.from_arrays([
                ids, labels, pa.array([None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw], pa.binary()),
                pa.array(raw, pa.binary()), pa.array(keys, pa.list_(pa.int32())),
            ], names=["vec_id", "label", "digest", "unit", "keys"])

    types = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    schema = f"vec_id {types['vec_id']}, label {types['label']}, digest binary, unit binary, keys array<int>"
    return vectors.select("vec_id", "label", "embedding").mapInArrow(run, schema)


def _linked(own: list, other: list | None, table: int, least: float):
    """Linked pairs of two blocks, or inside one, that no earlier table holds; as positions in ``own + other``."""
    rows = own + (other or [])
    x = np.array([np.frombuffer(r["unit"], dtype=np.float64) for r in rows])
    keys = np.array([r["keys"] for r in rows])
    n = len(own)
    a, b = np.nonzero(x[:n] @ (x[n:] if other is not None else x).T >= least)
    if other is not None:
        b += n
    else:
        a, b = a[a < b], b[a < b]
    new = (keys[a, table] == keys[b, table]) & ~(keys[a, :table] == keys[b, :table]).any(axis=1)
    return rows, a[new], b[new]


def _local_roots(n: int, a: np.ndarray, b: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Smallest value of ``order`` that each of ``n`` positions reaches over the pairs."""
    root = order.copy()
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        if (after == root).all():
            return root
        root = after


def near_duplicates(vectors: DataFrame, least: float = 0.93, tables: int = TABLES, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Only vectors of one label and length are compared. Equal vectors are one class with a count, so copies never meet
    in pairs; classes that share a code substring in any table are compared by cosine in double precision. A pair is
    counted in the first table that holds it, inside the task that finds it: tasks return counts and a spanning
    forest, not pairs. A table's bucket above ``block`` classes is cut into blocks that meet two by two in tasks of
    their own, so no bucket is capped. A null label, and a null, empty, zero or non-finite vector, links with nothing;
    a null id gives null component and kept; repeated rows count as vectors of their own; an empty table gives no
    rows; other columns are not read.
    """
    coded = stored(_code(vectors, fit(vectors), tables, width), "itq-codes")
    usable = coded.where("digest IS NOT NULL AND vec_id IS NOT NULL")
    classes = usable.groupBy("label", "digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    kind = coded.schema["vec_id"].dataType.simpleString()
    reps = usable.join(classes.withColumnRenamed("rep", "vec_id"), ["label", "digest", "vec_id"]).dropDuplicates(["label", "digest"])
    spread = reps.select(
        F.col("vec_id").alias("rep"), "n", "label", "unit", "keys", F.length("unit").alias("size"), F.posexplode("keys").alias("table", "key"))
    bucket = ["label", "size", "table", "key"]
    counts = reps.select("label", F.length("unit").alias("size"), F.posexplode("keys").alias("table", "key")).groupBy(*bucket).agg(F.count("*").alias("m")).where("m > 1")
    blocks = spread.join(counts, bucket).withColumn("blocks", F.ceil(F.col("m") / block).cast("int")).withColumn(
        "mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = blocks.withColumn("their", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *bucket, F.least("mine", "their").alias("low"), F.greatest("mine", "their").alias("high"), "mine", "rep", "n", "unit", "keys")

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        low, high, index = rows[0]["low"], rows[0]["high"], rows[0]["table"]
        left = [r for r in rows if r["mine"] == low]
        right = None if low == high else [r for r in rows if r["mine"] == high]
        out = {"rep": [], "links": [], "root": []}
        if left and (right is None or right):
            rows, a, b = _linked(left, right, index, least)
            weight = np.array([r["n"] for r in rows], dtype=np.int64)
            links = np.zeros(len(rows), dtype=np.int64)
            np.add.at(links, a, weight[b])
            np.add.at(links, b, weight[a])
            ids = sorted(range(len(rows)), key=lambda i: rows[i]["rep"])
            order = np.empty(len(rows), dtype=np.int64)
            order[ids] = np.arange(len(rows))
            roots = _local_roots(len(rows), a, b, order)
            for i in np.flatnonzero(links):
                out["rep"].append(rows[i]["rep"])
                out["links"].append(int(links[i]))
                out["root"].append(rows[ids[roots[i]]]["rep"])
        ids_type = table.schema.field("rep").type
        return pa.table({"rep": pa.array(out["rep"], ids_type), "links": pa.array(out["links"], pa.int64()), "root": pa.array(out["root"], ids_type)})

    found = stored(dealt.groupBy(*bucket, "low", "high").applyInArrow(run, f"rep {kind}, links bigint, root {kind}"), "itq-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    # Ids of several classes (repeated ids) tie those classes together as well.
    of_class = usable.join(classes, ["label", "digest"]).select("vec_id", "rep", "label", "digest", "n")
    group = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")).union(of_class.select("rep", "vec_id")))
    per_row = coded.select("vec_id", "label", "digest").join(classes, ["label", "digest"], "left").join(links, "rep", "left")
    joined = per_row.join(group, per_row["vec_id"] == group["node"], "left")
    return joined.select(
        "vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce(F.col("links") + F.col("n") - 1, F.col("n") - 1, F.lit(0))).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"), (F.col("vec_id") == F.coalesce("component", "vec_id")).alias("kept"),
    )
