"""Mixing sources to target weights: capped water-filling, then whole and fractional repetitions of documents."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from symbolweave.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_DIGITS = 3


def word_count(text):
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def repeating_weights(sources: DataFrame, weights: Sequence[int] = (5, 2, 1)) -> DataFrame:
    """Adds ``weight``: the given weights in turn over the sources by code point, null last.

    ``sources`` has one row per source, so the numbering handles names only, never documents.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place % len(weights) + 1).cast("int")))


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """Adds ``target`` to ``sources(source_size, weight)``: shares of ``total`` by weight, at most ``max_epochs`` sizes each.

    A source above its cap is clamped and the excess goes to the others by weight, again until none is above; the
    clamped set only grows, so each round is one aggregate and at most as many rounds as sources are needed. If all
    sources are clamped, the total cannot be reached and every target is its cap. Empty sources have target 0.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level, clamped = None, -1
    while True:
        over = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        row = sources.agg(
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
            F.count(F.when(over, 1)),
        ).first()
        if row[2] == clamped or not row[1]:
            level = level if row[1] else float("inf")
            break
        clamped, level = row[2], (float(total) - row[0]) / row[1]
    return sources.withColumn("target", F.when(F.col("weight") * F.lit(level) > cap, cap).otherwise(F.col("weight") * F.lit(level)))


def mix(
    documents: DataFrame, share: float = 1.5, max_epochs: float = 2.0, weights: Sequence[int] = (5, 2, 1), seed: int = 7,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, repeats, part, taken``.

    ``repeats`` whole copies and ``part`` words of one more (all, some or none) are taken. The fractional repetition
    takes documents of a source in the order of a seeded digest until the rest of the target is reached, so a source
    takes its rounded target exactly and reruns agree. The running sum is made of bucket sums and sums inside
    buckets: a source with most of the rows is spread over its buckets. Null or empty texts have size 0 and take
    nothing; a null source is a source of its own; rows with equal ids are rows of their own; a null id has its place
    in the order; an empty table gives no rows. Other columns are not read.
    """
    slim = stored(documents.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    sources = stored(repeating_weights(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights), "mix-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    targets = water_fill(sources, share * total, max_epochs).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    ).withColumn("need", F.floor(F.col("target") + 0.5) - F.col("whole") * F.col("source_size"))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    dealt = slim.withColumn("key", key).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    sums = dealt.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("offset"))
    offsets = offsets.alias("o").join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))).select(
        F.col("o.source").alias("o_source"), F.col("o.bucket").alias("o_bucket"), "offset", "source_size", "target", "whole", "need")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.join(offsets, placed["source"].eqNullSafe(F.col("o_source")) & (F.col("bucket") == F.col("o_bucket")))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("need") - F.col("offset") - F.col("inside"))).cast("long")
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", F.col("whole").cast("long").alias("repeats"), part.alias("part"),
        (F.col("whole") * F.col("size") + part).cast("long").alias("taken"),
    )


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The mix as documents: each row of ``documents`` as often as taken; one more copy if half of it or more is.

    Documents of size 0 are kept once. Ids are expected to be unique; rows that share an id each take the copies of
    every one of them. Rows with a null id are kept once, as they cannot be matched to their share.
    """
    plan = mix(documents, **options)
    copies = F.when(F.col("size") == 0, 1).otherwise(F.col("repeats") + ((F.col("part") > 0) & (2 * F.col("part") >= F.col("size"))).cast("long"))
    wanted = plan.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_mix_id")).agg(F.max(copies).cast("int").alias("_mix_copies"))
    joined = documents.join(wanted, documents["doc_id"] == F.col("_mix_id"), "left")
    repeated = joined.withColumn("_mix_copies", F.coalesce("_mix_copies", F.lit(1))).where("_mix_copies > 0")
    return repeated.withColumn("_mix_n", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(*[documents[c] for c in documents.columns])
