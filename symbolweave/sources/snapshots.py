"""Snapshot keys: which stored graphs are valid, current or missing."""

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import MIN_SHA_LENGTH
from ..functions.paths import snapshot_path


def valid_snapshot_key(repo: Column, head_sha: Column) -> Column:
    return (
        ~F.contains(head_sha, F.lit("/")) & ~F.contains(head_sha, F.lit("..")) & ~F.contains(repo, F.lit(".."))
        & (F.length(head_sha) >= MIN_SHA_LENGTH)
    )


def accepted_keys(keys: DataFrame) -> DataFrame:
    return keys.filter(valid_snapshot_key(F.col("repo"), F.col("head_sha"))).withColumn(
        "path", snapshot_path(F.col("repo"), F.col("head_sha")),
    )


def rejected_keys(keys: DataFrame) -> DataFrame:
    return keys.filter(~F.coalesce(valid_snapshot_key(F.col("repo"), F.col("head_sha")), F.lit(False)))


def plan_rebuild(requested: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Requested ``(repo, head_sha)`` keys that have no snapshot yet."""
    return requested.join(snapshots, ["repo", "head_sha"], "left_anti")


def snapshot_hits(requested: DataFrame, snapshots: DataFrame) -> DataFrame:
    return requested.join(snapshots, ["repo", "head_sha"], "left_semi")


def latest_snapshot(snapshots: DataFrame, keys=()) -> DataFrame:
    """Newest snapshot path, overall or per key; ties go to the greater path. Empty in, empty out."""
    newest = snapshots.groupBy(*keys).agg(F.max(F.struct("modified", "path")).alias("newest"))
    return newest.filter("newest is not null").select(*keys, F.col("newest.path"), F.col("newest.modified"))


def discover_snapshots(spark, root: str) -> DataFrame:
    """Snapshots written under ``root/<name>/`` with their modification time.

    Only the small properties files of each snapshot are listed.
    """
    files = spark.read.format("binaryFile").load(f"{root}/*/properties/graph-*.json").select("path", "modificationTime")
    return files.groupBy(F.regexp_extract("path", "^(.*)/properties/[^/]*$", 1).alias("path")).agg(
        F.max("modificationTime").alias("modified"),
    )


def adopt_corpus(requested: DataFrame, corpus: DataFrame, session: DataFrame) -> DataFrame:
    """Graph to use per repository: the corpus one when it exists, else the session's own."""
    return (
        requested.join(corpus.select("repo", F.col("path").alias("corpus_path")), "repo", "left")
        .join(session.select("repo", F.col("path").alias("session_path")), "repo", "left")
        .select(
            "repo", F.coalesce("corpus_path", "session_path").alias("path"),
            F.col("corpus_path").isNotNull().alias("adopted"),
        )
    )
