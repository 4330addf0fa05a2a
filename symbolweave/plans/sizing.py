"""Checks made before a side of a join is broadcast."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

# A broadcast side stays below both limits; beyond either one the join is shuffled.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class InputProfile:
    rows: int
    size: int
    classes: tuple

    def times(self, copies):
        """The profile of the same rows, each as often."""
        return InputProfile(self.rows * copies, self.size * copies, self.classes)

    @property
    def small(self):
        return self.rows <= BROADCAST_ROWS and self.size <= BROADCAST_BYTES


def profile(df: DataFrame, class_column: str | None = None) -> InputProfile:
    """Row count and string bytes of a query input, and the values of a small class column.

    One aggregate over the input; its result is a single row. Counting stops early for
    neither measure, so a large input costs one map-side scan and is then shuffled.
    """
    text = [F.octet_length(F.coalesce(F.col(f.name).cast("string"), F.lit(""))) for f in df.schema.fields]
    width = sum(text[1:], text[0]) + 16
    classes = F.collect_set(class_column) if class_column else F.array()
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b"), classes.alias("c")).first()
    return InputProfile(row["n"], row["b"] or 0, tuple(sorted(row["c"])))


def hinted(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast only what was measured to be small."""
    return F.broadcast(df) if small else df


def never_broadcast(df: DataFrame) -> DataFrame:
    """A side that grows with the input, read from files: their compressed size may be a hundredth of that of the rows.

    Without the hint the planner takes the size of the files for that of the rows and sends millions of them to the driver.
    """
    return df.hint("merge")


# A task sorts and hashes its rows several times at once; so many of an edge take some 300 MB.
ROWS_PER_TASK = 250_000


def dealt(df: DataFrame, rows: int, *keys) -> DataFrame:
    """``df`` dealt by ``keys`` to as many tasks as ``rows`` call for, so that a task's memory does not grow with the tables.

    The adaptive planner gathers partitions up to a size of compressed bytes, of which rows take a hundredfold in memory.
    Few rows are left to it.
    """
    tasks = -(-rows // ROWS_PER_TASK)
    return df.repartition(tasks, *keys) if tasks > df.sparkSession.sparkContext.defaultParallelism else df
