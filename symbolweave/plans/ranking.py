"""Ordered numbering and per-key caps that do not gather a hot key in one task."""

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .tables import written


def top_per_key(df: DataFrame, keys, order, cap, rank="row_number", column=None) -> DataFrame:
    """First ``cap`` rows per key. ``None`` keeps every row and needs no window.

    The filter on the rank lets Spark cut each partition to ``cap`` rows per key before
    the shuffle, so one hot key never moves more than ``cap`` rows per map task.
    """
    if cap is None:
        return df
    window = Window.partitionBy(*keys).orderBy(*order)
    name = column or "_position"
    ranked = df.withColumn(name, getattr(F, rank)().over(window)).filter(F.col(name) <= cap)
    return ranked if column else ranked.drop(name)


def number_within(df: DataFrame, keys, bucket: Column, order, column: str) -> DataFrame:
    """0-based position of every row inside its key, for keys of any size.

    ``bucket`` must not decrease along ``order``. Rows are sorted per (key, bucket) only;
    the start of a bucket is a running sum over the bucket counts of its key, one row per
    bucket, so the rows of a hot key are spread over its buckets.
    """
    keys = list(keys)
    spread = df.withColumn("_bucket", bucket)
    counts = spread.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    numbered = spread.withColumn("_rank", F.row_number().over(inside) - 1).join(starts, [*keys, "_bucket"])
    return numbered.select(*df.columns, (F.col("_start") + F.col("_rank")).cast("bigint").alias(column))


def _with_run_places(keys, place):
    """Arrow step that numbers the rows of each run of equal keys; it needs no import of this package on the workers."""
    def step(batches):
        import numpy as np
        import pyarrow as pa

        last, count = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            fresh = np.zeros(n, dtype=bool)
            for name in keys:
                codes = batch.column(name).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                fresh[1:] |= codes[1:] != codes[:-1]
            first = tuple(batch.column(name)[0].as_py() for name in keys)
            carried = count if first == last else 0
            starts = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
            places = np.arange(n) - starts + np.where(starts == 0, carried, 0)
            last, count = tuple(batch.column(name)[n - 1].as_py() for name in keys), int(places[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], names=[*batch.schema.names, place])

    return step


def number_sorted(df: DataFrame, keys, order, column: str) -> DataFrame:
    """0-based position of every row inside its key, in one shuffle, however the rows of a key lie.

    Rows are dealt by range over key and order together, so a key with most of the rows, even all on one line, is spread
    over many tasks. Each task numbers its runs as they pass; only a key that goes on in the next task needs the count
    before it, at most one per task, so that side of the join is never larger than the number of tasks. Keys hold no null.
    """
    keys = list(keys)
    dealt = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("_part", F.spark_partition_id())
    fields = T.StructType([*dealt.schema.fields, T.StructField("_place", T.LongType())])
    placed = written(dealt.mapInArrow(_with_run_places(keys, "_place"), fields), "numbered")
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    going_on = counts.withColumn("_start", F.sum("_n").over(before)).filter("_start > 0").drop("_n")
    numbered = placed.join(F.broadcast(going_on), [*keys, "_part"], "left")
    return numbered.select(*df.columns, (F.coalesce("_start", F.lit(0)) + F.col("_place")).alias(column))


ID_BUCKETS = 4096


def add_stable_spans(df: DataFrame, scope: str, natural_key: Column, size: Column, column: str) -> DataFrame:
    """Room for ``size`` ids per distinct row inside ``scope``: the ids are ``span_id(column, i)`` for i below the size.

    As with ``add_stable_id``, hash buckets are numbered apart; the running sum of a bucket's sizes leaves no gap to run over.
    """
    spread = df.withColumn("_key", natural_key).withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(ID_BUCKETS)))
    before = Window.partitionBy(scope, "_bucket").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(size).over(before), F.lit(0))
    return spread.withColumn(column, F.struct(start.cast("bigint").alias("start"), F.col("_bucket").alias("bucket"))).drop("_key", "_bucket")


def span_id(span: Column, place: Column) -> Column:
    return ((span["start"] + place) * ID_BUCKETS + span["bucket"]).cast("bigint")


def add_stable_id(df: DataFrame, scope: str, natural_key: Column, column: str) -> DataFrame:
    """Number distinct rows inside ``scope`` with integers that depend only on the data.

    Rows are numbered per hash bucket of their natural key and the bucket is folded into
    the id, so ids are unique and repeatable, and a scope with most of the rows is still
    numbered by thousands of independent groups.
    """
    spread = df.withColumn("_key", natural_key).withColumn(
        "_bucket", F.pmod(F.xxhash64("_key"), F.lit(ID_BUCKETS)),
    )
    rank = F.row_number().over(Window.partitionBy(scope, "_bucket").orderBy("_key")) - 1
    return spread.withColumn(column, (rank * ID_BUCKETS + F.col("_bucket")).cast("bigint")).drop("_key", "_bucket")
