"""A symbol graph derived from star-schema order tables.

Orders become documents, line items become chunks and mentions, parts become symbols. It
gives every operator a graph whose size grows with the given tables.
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .. import schema
from ..graph import CodeGraph
from ..plans.sizing import dealt, never_broadcast
from ..plans.tables import written


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def repository():
    return F.concat(F.lit("repo-"), F.pmod(F.col("o_custkey"), F.lit(5)).cast("string"))


def part_monikers(spark, folder) -> DataFrame:
    """One moniker per part; every tenth part is a symbol local to its source."""
    key = F.col("p_partkey").cast("string")
    package = F.concat(
        F.lit("scip-go gomod github.com/org/"), F.replace(F.col("p_brand"), F.lit("#"), F.lit("-")), F.lit(" v"),
        F.col("p_size").cast("string"), F.lit(" `github.com/org/"), F.lower("p_type"), F.lit("`/"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.lit("#"),
    )
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("part_id"),
        F.when(F.col("p_partkey") % 10 == 0, F.concat(F.lit("local "), key)).otherwise(package).alias("symbol"),
    )


def order_documents(spark, folder, text_paths=False) -> DataFrame:
    """One document per order. With ``text_paths`` an order whose key is a text document is
    placed at the path of that text."""
    key = F.col("o_orderkey").cast("string")
    priority = F.substring("o_orderpriority", 1, 1)
    folder_name = F.lit("handlers")
    for digit, name in (("1", "publisher"), ("2", "consumer"), ("3", "internal"), ("4", "pkg")):
        folder_name = F.when(priority == digit, name).otherwise(folder_name)
    path = F.concat(
        folder_name, F.lit("/order_"), key, F.when(F.col("o_orderkey") % 50 == 0, ".pb.go").otherwise(".go"),
    )
    orders = table(spark, folder, "orders")
    if text_paths:
        texts = table(spark, folder, "documents").select("doc_id", "lang")
        orders = orders.join(texts, F.col("o_orderkey") == F.col("doc_id"), "left").drop("doc_id")
        path = F.when(F.col("lang").isNotNull(), text_path(F.col("lang"), key)).otherwise(path)
    language = F.when(F.col("o_orderstatus") == "F", "go").when(F.col("o_orderstatus") == "O", "typescript")
    return orders.select(
        repository().alias("source"), F.col("o_orderkey").alias("doc_id"), path.alias("relative_path"),
        language.otherwise("python").alias("language"), F.lit("UTF8").alias("position_encoding"),
        F.lit(None).cast("string").alias("text"),
    )


def text_path(language, key):
    return F.concat(language, F.lit("/doc_"), key, F.lit(".txt"))


def line_role():
    role = F.lit(None).cast("int")
    for flag, status, value in (
        ("R", "F", 1), ("R", "O", 17), ("A", "F", 8), ("A", "O", 4), ("N", "F", 2), ("N", "O", 0),
    ):
        role = F.when((F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status), value).otherwise(role)
    return role


def part_names(spark, folder) -> DataFrame:
    """Monikers of parts with a short number of theirs: the smallest part of that name, and its place among the names of that part."""
    first = part_monikers(spark, folder).withColumn("first_part", F.min("part_id").over(Window.partitionBy("symbol")))
    return first.withColumn("nth_name", F.dense_rank().over(Window.partitionBy("first_part").orderBy("symbol")))


def star_edges(spark, folder) -> DataFrame:
    """Distinct (order, line, part, role) of known parts with the source of the order.

    A moniker is ten times as long as the rest of its edge, so edges hold its number. ``leads_line`` marks one edge of each
    line and ``leads_name`` one of each line, name and role, while the edges of an order still lie in one task.
    """
    named = part_names(spark, folder).select("part_id", "first_part", "nth_name").distinct()
    items = table(spark, folder, "lineitem")
    rows = items.count()
    lines = items.select(
        F.col("l_orderkey").alias("doc_id"), "l_linenumber", F.col("l_partkey").alias("part_id"),
        line_role().alias("role"),
    ).join(never_broadcast(named), "part_id")
    orders = table(spark, folder, "orders").select(repository().alias("source"), F.col("o_orderkey").alias("doc_id"))
    line, name = ["source", "doc_id", "l_linenumber"], ["first_part", "nth_name", "role"]
    first = lambda keys, order: F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1
    return (
        dealt(lines, rows, "doc_id").join(never_broadcast(dealt(orders, rows, "doc_id")), "doc_id").distinct()
        .withColumn("leads_line", first(line, [*name, "part_id"]))
        .withColumn("leads_name", first([*line, *name], ["part_id"]))
    )


def named_edges(spark, folder, edges: DataFrame) -> DataFrame:
    """Line edges with the moniker of their part."""
    return edges.drop("first_part", "nth_name").join(never_broadcast(part_monikers(spark, folder)), "part_id")


def star_graph(spark: SparkSession, folder: str, edges: DataFrame | None = None, text_paths: bool = False) -> CodeGraph:
    """Five sources side by side, not yet merged. ``edges`` may be a stored ``star_edges``.

    The smallest part of a name in a source is the name's id there. Names are written once, as three tables read them.
    """
    edges = star_edges(spark, folder) if edges is None else edges
    name = ["first_part", "nth_name"]
    monikers = part_names(spark, folder).select(*name, "symbol").distinct()
    names = written(
        edges.groupBy("source", *name).agg(F.min("part_id").alias("symbol_id")).join(never_broadcast(monikers), name), "star-names",
    )
    owned = names.drop(*name)
    ids = names.filter("symbol IS NOT NULL").select("source", *name, "symbol_id")
    chunk_id = F.col("doc_id") * 10 + F.col("l_linenumber")
    chunk_index = F.col("l_linenumber") - 1
    mentions = edges.filter("leads_name").join(never_broadcast(ids), ["source", *name]).select(
        "source", chunk_id.alias("chunk_id"), "doc_id", chunk_index.alias("chunk_index"), "symbol_id", "role",
    )
    if not ids.groupBy("source", "symbol_id").count().filter("count > 1").isEmpty():
        mentions = mentions.distinct()  # parts of several names, which then share an id
    start = F.col("chunk_index") * 20
    ranges = mentions.filter((F.col("role") == 1) & (F.col("chunk_index") % 2 == 0)).select(
        "source", F.col("source").alias("symbol_source"), "symbol_id", "doc_id",
        (start + 2).cast("int").alias("start_line"), F.lit(0).alias("start_char"),
        (start + 2 + F.col("symbol_id") % 15).cast("int").alias("end_line"), F.lit(1).alias("end_char"),
    )
    lower = owned.select("source", (F.col("symbol_id") + 1).alias("symbol_id"), F.col("symbol").alias("target"))
    relationship = F.struct(
        F.col("target").alias("symbol"), (F.col("symbol_id") % 2 == 0).alias("is_reference"),
        (F.col("symbol_id") % 3 == 0).alias("is_implementation"), F.lit(False).alias("is_type_definition"),
        F.lit(False).alias("is_definition"),
    )
    symbols = owned.join(lower, ["source", "symbol_id"], "left").select(
        F.col("source").alias("symbol_source"), "symbol_id", "symbol", F.lit("").alias("display_name"),
        F.lit(None).cast("int").alias("kind"), F.lit(None).cast("string").alias("documentation"),
        F.when(F.col("target").isNotNull(), F.array(relationship)).alias("relationships"),
    )
    chunks = edges.filter("leads_line").select(
        "source", chunk_id.alias("chunk_id"), "doc_id", chunk_index.cast("int").alias("chunk_index"),
        start_of("l_linenumber").alias("start_line"), (start_of("l_linenumber") + 19).alias("end_line"),
    )
    return CodeGraph(
        documents=order_documents(spark, folder, text_paths),
        symbols=symbols,
        chunks=chunks,
        mentions=mentions.select(
            "source", "chunk_id", F.col("source").alias("symbol_source"), "symbol_id", "role",
        ),
        definition_ranges=ranges.select(*schema.DEFINITION_RANGES.fieldNames()),
    )


def start_of(line_number):
    return ((F.col(line_number) - 1) * 20).cast("int")


def text_files(spark, folder) -> DataFrame:
    """Texts that belong to a star-graph document, under the path and source of that document."""
    texts = table(spark, folder, "documents").select(
        "doc_id", text_path(F.col("lang"), F.col("doc_id").cast("string")).alias("file"), "text",
    )
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("doc_id"), repository().alias("source"))
    return texts.join(orders, "doc_id").select("source", "file", "text")
