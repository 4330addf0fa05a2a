"""Grouped views of query results.

Without a limit every view but ``joined_names``, whose result is one text a query, is rows: its groups can be of any size.
With a limit the rows of a group are cut to it before they are shuffled, and collected into a list no longer than that.
"""

from pyspark.sql import DataFrame, functions as F

from ..functions import ranges
from ..plans.ranking import top_per_key


def references_by_name(references: DataFrame, limit: int | None = None) -> DataFrame:
    """Locations per display name; with a limit the number of occurrences and a list of the first ones in result order."""
    keys = ["query_id", "display_name"]
    location = ranges.render_location(F.col("file"), F.col("start_line"), F.col("end_line"), F.col("start_char"))
    placed = references.withColumn("location", location)
    if limit is None:
        return placed.select(*keys, "location")
    order = ["length_rank", "file", "start_line", "end_line", "location"]
    first = top_per_key(placed, keys, [F.col(c) for c in order], limit).groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(*order))), lambda e: e["location"]).alias("locations"),
    )
    return placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_occurrences")).join(first, keys)


def symbols_by_file(listed: DataFrame, limit: int | None = None) -> DataFrame:
    """Names with their first line per query and file; with a limit as a list of the first ones."""
    keys = ["query_id", "file"]
    shown = listed.select(*keys, "start_line", "display_name", F.format_string("%s (line %d)", "display_name", "start_line").alias("entry"))
    if limit is None:
        return shown.select(*keys, "entry")
    order = ["start_line", "display_name", "entry"]
    first = top_per_key(shown, keys, [F.col(c) for c in order], limit)
    return first.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(*order))), lambda e: e["entry"]).alias("symbols"),
    )


def distinct_names(found: DataFrame, limit: int | None = None) -> DataFrame:
    """Distinct display names per query; with a limit as a sorted list of the first ones."""
    names = found.select("query_id", "display_name").distinct()
    if limit is None:
        return names
    first = top_per_key(names, ["query_id"], [F.col("display_name")], limit)
    return first.groupBy("query_id").agg(F.array_sort(F.collect_list("display_name")).alias("names"))


def joined_names(found: DataFrame) -> DataFrame:
    """All distinct display names of a query, sorted and joined by commas."""
    listed = F.array_sort(F.collect_list("display_name"))
    return distinct_names(found).groupBy("query_id").agg(F.array_join(listed, ", ").alias("names"))
