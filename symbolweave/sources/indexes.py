"""Tables stored beside a graph that answer a lookup from a few of their partitions.

``grams``: three-letter pieces of the lower-cased monikers with the symbols that hold them, by piece, and how many hold
each. ``names``: symbols by display name, with bloom filters. ``paths``: definition sites in path order, cut into parts
whose first and last path are part of the graph's commit. ``targets``: relationships by what they point to.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import schema
from ..functions import monikers, text
from ..graph import SYMBOL_KEY, CodeGraph

GRAM = 3
_S, _L, _I, _B = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()


def _struct(*fields):
    return T.StructType([T.StructField(n, k) for n, k in fields])


_KEY = (("symbol_source", _S), ("symbol_id", _L))
TABLES = {
    "grams": _struct(("gram", _S), *_KEY, ("gram_bucket", _I)),
    "gram_counts": _struct(("gram", _S), ("n", _L), ("gram_bucket", _I)),
    "names": _struct(("display_name", _S), *_KEY, ("symbol", _S), ("name_bucket", _I)),
    "paths": _struct(*[(f.name, f.dataType) for f in schema.DEFINITION_SITES.fields if f.name != "symbol_bucket"], ("path_part", _I)),
    "targets": _struct(
        ("target_key", _S), ("target", _S), *_KEY, ("symbol", _S), ("is_reference", _B), ("is_implementation", _B),
        ("is_type_definition", _B), ("is_definition", _B), ("target_bucket", _I)),
}


@dataclass(frozen=True)
class GraphIndexes:
    """The stored tables, their number of buckets, and ``(part, first, last)`` of the parts of ``paths``."""

    grams: DataFrame
    gram_counts: DataFrame
    names: DataFrame
    paths: DataFrame
    targets: DataFrame
    buckets: int
    path_splits: tuple


def bucket_of(value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


def target_key(moniker: Column) -> Column:
    """What a moniker means whatever its package and version."""
    return monikers.dedup_key(moniker, F.lit(""))


def grams_of(lowered: Column) -> Column:
    """Distinct pieces of ``GRAM`` letters; none for a shorter text."""
    pieces = F.transform(F.sequence(F.lit(1), F.length(lowered) - (GRAM - 1)), lambda i: F.substring(lowered, i, F.lit(GRAM)))
    return F.when(F.length(lowered) >= GRAM, F.array_distinct(pieces)).otherwise(F.array().cast("array<string>"))


def _bucketed(table, folder, bucket, order):
    table.hint("rebalance", bucket).sortWithinPartitions(bucket, *order).write.option(
        "parquet.bloom.filter.enabled#display_name", "true",
    ).partitionBy(bucket).parquet(folder)


def write_indexes(spark: SparkSession, stored: CodeGraph, folder: str, buckets: int) -> list:
    """Write the tables from a stored graph and return the splits of ``paths``."""
    symbols = stored.symbols.filter(F.col("symbol").isNotNull()).select(*SYMBOL_KEY, "symbol")
    spread = symbols.select(F.explode(grams_of(text.ascii_lower(F.col("symbol")))).alias("gram"), *SYMBOL_KEY).withColumn(
        "gram_bucket", bucket_of(F.col("gram"), buckets),
    )
    _bucketed(spread, f"{folder}/grams", "gram_bucket", ["gram"])
    grams = spark.read.schema(TABLES["grams"]).parquet(f"{folder}/grams")
    _bucketed(grams.groupBy("gram", "gram_bucket").agg(F.count(F.lit(1)).alias("n")).select("gram", "n", "gram_bucket"),
              f"{folder}/gram_counts", "gram_bucket", ["gram"])
    shown = symbols.withColumn("display_name", monikers.display_name(F.col("symbol")))
    names = shown.withColumn("name_bucket", bucket_of(F.col("display_name"), buckets))
    _bucketed(names.select(*TABLES["names"].fieldNames()), f"{folder}/names", "name_bucket", ["display_name"])
    edges = stored.relationships().withColumn("target_key", target_key(F.col("target")))
    edges = edges.withColumn("target_bucket", bucket_of(F.col("target_key"), buckets))
    _bucketed(edges.select(*TABLES["targets"].fieldNames()), f"{folder}/targets", "target_bucket", ["target_key"])

    # Line numbers are part of the order, so a file with most of the definitions lies in many parts.
    order = ["path_key", "start_line", "start_char", "symbol"]
    ranged = stored.definition_sites().withColumn("path_key", text.ascii_lower(F.col("relative_path")))
    ranged = ranged.repartitionByRange(buckets, *order).sortWithinPartitions(*order).withColumn("path_part", F.spark_partition_id())
    ranged.select(*TABLES["paths"].fieldNames()).write.partitionBy("path_part").parquet(f"{folder}/paths")
    low = text.ascii_lower(F.col("relative_path"))
    paths = spark.read.schema(TABLES["paths"]).parquet(f"{folder}/paths")
    splits = paths.groupBy("path_part").agg(F.min(low).alias("first"), F.max(low).alias("last"))
    return [list(r) for r in splits.orderBy("path_part").collect()]  # one row per part


def read_indexes(spark: SparkSession, folder: str, buckets: int, splits) -> GraphIndexes:
    tables = {name: spark.read.schema(fields).parquet(f"{folder}/{name}") for name, fields in TABLES.items()}
    return GraphIndexes(**tables, buckets=buckets, path_splits=tuple(tuple(s) for s in splits))


def parts_of_prefix(splits, prefix: Column) -> Column:
    """Parts of ``paths`` that can hold a path with the prefix: an interval of them."""
    kind = "array<struct<part:int,first:string,last:string>>"
    known = F.array(*[F.struct(F.lit(p).alias("part"), F.lit(a).alias("first"), F.lit(b).alias("last")) for p, a, b in splits]).cast(kind)
    inside = lambda s: (s["last"] >= prefix) & ((s["first"] <= prefix) | F.startswith(s["first"], prefix))
    return F.transform(F.filter(known, inside), lambda s: s["part"])
