"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from symbolweave.llm.common import stored

SIZES, BITS = (3, 4, 5), 20
SAMPLE_ROWS, FEATURES, LEAST_COUNT, STEPS, DECAY = 12_000, 8192, 5, 150, 1e-4


def gram_buckets(text: str) -> np.ndarray:
    """Hash bucket of every n-gram of the text in lower case, white space runs as one space and one at either end."""
    codes = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out, h = [], np.zeros(len(codes), dtype=np.uint32)
    for n in range(1, max(SIZES) + 1):
        if n > len(codes):
            break
        h = h[: len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1 :] + np.uint32(1)
        if n in SIZES:
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            out.append((mixed ^ (mixed >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint32)


class Model:
    """Slots of the chosen buckets, a weight for each, and an intercept."""

    def __init__(self, buckets: np.ndarray, weights: np.ndarray, intercept: float):
        self.slot = np.zeros(1 << BITS, dtype=np.int16)
        self.slot[buckets] = np.arange(1, len(buckets) + 1)
        self.weights = np.concatenate(([0.0], weights))
        self.intercept = intercept

    def features(self, text: str) -> np.ndarray:
        """Slots that occur in the whole text."""
        seen = np.zeros(len(self.weights), dtype=bool)
        seen[self.slot[gram_buckets(text)]] = True
        seen[0] = False
        return np.flatnonzero(seen)

    def score(self, text: str) -> float:
        line = self.intercept + self.weights[self.features(text)].sum()
        return float(1 / (1 + np.exp(-np.clip(line, -500, 500))))


def labelled_sample(documents: DataFrame, labels: DataFrame, usable: Column, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``text, y`` of the ``rows`` usable labelled ids with the smallest hash, with their whole texts.

    Labels other than 0 and 1 are left out; an id with both is 1. Of rows with one id one text is taken, that with the
    smallest hash. The ids of the sample have a fixed bound, so they are broadcast and no text is shuffled but the sample's.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & usable)
    few = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y")).orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(rows)
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(few), "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
    return found.select("t.text", "y")


def fit(sample: DataFrame) -> Model:
    """Log-count ratios and weights from ``sample(text, y)``.

    Documents that hold a bucket are counted per class by Spark; the buckets with the strongest ratios for their
    counts are the features. The linear classifier is fitted on the scaled features of the same bounded sample. With
    one class only, or no rows, no feature is chosen and the score is the smoothed share of class 1.
    """
    sample = stored(sample.repartition(12), "toxicity-sample")

    def count(batches):
        by = np.zeros((2, 1 << BITS), dtype=np.int32)
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by[y, np.unique(gram_buckets(text))] += 1
        at = np.flatnonzero(by.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(by[0, at], pa.int64()), pa.array(by[1, at], pa.int64())], names=["bucket", "n0", "n1"])

    sizes = {row["y"]: row["n"] for row in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    prior = float(np.log((n1 + 1) / (n0 + 1)))
    if not n0 or not n1:
        return Model(np.zeros(0, int), np.zeros(0), prior)
    counts = sample.mapInArrow(count, "bucket int, n0 bigint, n1 bigint").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    ratio = F.log((F.col("n1") + 1) / F.lit(n1 + 2.0)) - F.log((F.col("n0") + 1) / F.lit(n0 + 2.0))
    strength = F.abs(F.col("ratio")) * F.sqrt(F.least(F.col("n0") + F.col("n1"), F.lit(n0 + n1) - F.col("n0") - F.col("n1")))
    chosen = counts.where(F.col("n0") + F.col("n1") >= LEAST_COUNT).withColumn("ratio", ratio).orderBy(F.desc(strength), "bucket").limit(FEATURES)
    rows = chosen.select("bucket", "ratio").collect()
    buckets, ratios = np.array([r[0] for r in rows], dtype=int), np.array([r[1] for r in rows])
    empty = Model(buckets, np.zeros(len(buckets)), 0.0)

    def encode(batches):
        for batch in batches:
            found = [empty.features(t).tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["y", "slots"])

    data = sample.mapInArrow(encode, "y int, slots array<int>").toArrow()
    y = data.column("y").to_numpy().astype(float)
    slots = data.column("slots").combine_chunks()
    cols = slots.flatten().to_numpy() - 1
    lines = np.repeat(np.arange(len(y)), slots.value_lengths().to_numpy())
    weights, intercept = _logistic(lines, cols, ratios, y, prior)
    return Model(buckets, weights * ratios, intercept)


def _logistic(lines, cols, ratios, y, prior):
    """Weights of the scaled features by Adam steps on the regularised logistic loss."""
    values = ratios[cols]
    w, b = np.zeros(len(ratios)), prior
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(lines, weights=values * w[cols], minlength=len(y)) + b, -30, 30)))
        error = p - y
        grad = np.append(np.bincount(cols, weights=values * error[lines], minlength=len(w)) / len(y) + DECAY * w, error.mean())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def score_documents(documents: DataFrame, model: Model, held_out: Column | None = None, threshold: float = 0.7) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted``, from the whole text.

    A null or empty text scores what the intercept gives. Rows with equal or null ids are rows of their own (held_out
    is null for a null id); other columns are not read; an empty table gives no rows.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    held = F.lit(None).cast("boolean") if held_out is None else held_out

    def run(batches):
        work = shared.value
        for batch in batches:
            scores = [work.score(t.as_py() or "") for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", held.alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def without_toxic(documents: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``documents`` whose whole text scores below ``threshold``; all columns stay, no row is shuffled."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")

    def run(batches):
        work = shared.value
        for batch in batches:
            yield batch.filter(pa.array([work.score(t.as_py() or "") < threshold for t in batch.column(at)], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
