"""Numbered commit files: the state of a folder is its highest commit, and a commit is one rename that never replaces a file."""

import json
import uuid

from pyspark.sql import SparkSession, functions as F


class CommitConflict(Exception):
    """Another writer committed the same number first."""


def _numbered(folder, name, number):
    return f"{folder}/{name}-{number:010d}.json"


def latest_commit(spark: SparkSession, folder: str, name: str):
    """``(number, state)`` of the highest commit. A folder without one is an ``AnalysisException``."""
    found = spark.read.format("binaryFile").load(f"{folder}/{name}-*.json").agg(F.max("path")).first()[0]
    number = int(found.rsplit("-", 1)[1].removesuffix(".json"))
    return number, json.loads(spark.read.text(found, wholetext=True).first()[0])


def commit(spark: SparkSession, folder: str, name: str, number: int, state: dict) -> None:
    """Make ``state`` the commit of that number. Readers see the one before until the rename, and the whole one after it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    pending, target = path(f"{folder}/.pending-{uuid.uuid4().hex}"), path(_numbered(folder, name, number))
    out = pending.getFileSystem(conf).create(pending, False)
    try:
        out.write(bytearray(json.dumps(state), "utf-8"))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    nothing = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    qualified = [context.makeQualified(p) for p in (pending, target)]
    try:
        context.rename(*qualified, nothing)
    except Exception as error:
        pending.getFileSystem(conf).delete(pending, False)
        if "FileAlreadyExists" in str(error):
            raise CommitConflict(f"{target} is there already") from error
        raise


def children(spark: SparkSession, folder: str):
    """``(name, milliseconds of the last change)`` of what lies in a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [(s.getPath().getName(), s.getModificationTime()) for s in system.listStatus(path)] if system.exists(path) else []


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
