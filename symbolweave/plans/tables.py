"""Tables written between jobs, in a folder that every executor reaches."""

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, for tables written between jobs."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return tempfile.mkdtemp(prefix="symbolweave-")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: later jobs, and lost executors, start from its files."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, *writes) -> None:
    """Run writes that do not need each other at the same time: one that waits for its last tasks leaves no core idle."""
    with ThreadPoolExecutor(len(writes)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
    for write in running:
        write.result()
