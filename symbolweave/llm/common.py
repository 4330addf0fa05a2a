"""Helpers shared by the operators: the shared folder, written tables, row identity and byte hashing."""

import gc
import os
import shutil
import tempfile
import uuid
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL = []
_SHIPPED = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors and the driver share: ``spark.checkpoint.dir``, or in local mode one made for the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="symbolweave-"))
    return _LOCAL[0]


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors' Python workers, once per Spark application."""
    context = spark.sparkContext
    if _SHIPPED.get("to") != context.applicationId:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        name = os.path.join(tempfile.mkdtemp(prefix="symbolweave-"), "symbolweave")
        context.addPyFile(shutil.make_archive(name, "zip", os.path.dirname(package), os.path.basename(package)))
        _SHIPPED["to"] = context.applicationId


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again, which ends its lineage at files."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Removes tables of ``stored`` that nothing will read again."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def swept(df: DataFrame, name: str) -> DataFrame:
    """``stored``, after which the driver collects its garbage: what the finished steps shuffled leaves the disks."""
    table = stored(df, name)
    gc.collect()
    df.sparkSession._jvm.System.gc()
    return table


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null stays null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


@lru_cache(maxsize=1)
def _mixers():
    rng = np.random.Generator(np.random.PCG64(20240229))
    table = rng.integers(1, 2**63, size=256, dtype=np.uint64) | np.uint64(1)
    base = int(rng.integers(1, 2**62)) * 4 + 1
    return table, base


_POWERS = {}


def _powers(n: int):
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of each."""
    have = _POWERS.get("n", 0)
    if have < n:
        _, base = _mixers()
        size = max(n, 2 * have, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        for key, value in (("up", base), ("down", inverse)):
            steps = np.full(size, value, dtype=np.uint64)
            steps[0] = 1
            _POWERS[key] = np.multiply.accumulate(steps)
        _POWERS["n"] = size
    return _POWERS["up"], _POWERS["down"]


def finish(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (an invertible mixing step)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running hash of bytes: entry ``i`` covers the first ``i`` bytes."""
    table, _ = _mixers()
    up, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(table[data] * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans ``[start, end)``, equal for equal bytes anywhere."""
    _, down = _powers(len(prefix))
    return finish((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(text: bytes) -> np.ndarray:
    """Hash of each word (run of bytes other than ASCII white space) of the text with A-Z in lower case."""
    data = _LOWER[np.frombuffer(text, dtype=np.uint8)]
    if not len(data):
        return np.zeros(0, dtype=np.uint64)
    solid = np.concatenate(([False], ~_SPACE[data], [False]))
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    return span_hash(prefix_hash(data), edges[0::2], edges[1::2])


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; a shorter text gives its whole sequence as one."""
    words = word_hashes(text)
    if not len(words):
        return words
    count = max(1, len(words) - width + 1)
    mixed = np.zeros(count, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(width, len(words))):
            mixed = finish(mixed * np.uint64(0x9E3779B97F4A7C15) + words[k : k + count])
    return np.unique(mixed)
