"""Query inputs and stored graphs shared by the catalog modules."""

from pyspark.sql import functions as F

from ..operators.grep import source_lines
from ..operators.merge import merge_sources
from ..sources import star_inputs
from ..sources.starschema import named_edges, star_edges, star_graph, table, text_files
from ..sources.store import stored_once, stored_table

NAMES = ("red_widget", "WIDGET", "red_", "anvil", "local", "nothing_here", "", "org/small")
SCOPES = ("repo-1/publisher/", "REPO-2/pkg/order_1", "repo-_/consumer/order_9", "repo-3", "nowhere", "")
MESSAGES = ("red_widget", "small_ring", "gizmo", "local 1", "nothing_here")
# Few partitions keep the edge table of the small test scales in few files.
TEST_BUCKETS = 8


def rows(spark, column, values):
    """One query per value, named by the value itself."""
    listed = F.explode(F.array(*[F.lit(v) for v in values])).alias("query_id")
    return spark.range(1).select(listed).withColumn(column, F.col("query_id"))


def batch_names(spark, folder):
    """Every part name as a query."""
    name = F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))
    return table(spark, folder, "part").select(name.alias("query_id"), name.alias("name")).distinct()


def edges(spark, folder):
    return stored_table(spark, f"edges{folder}", lambda: star_edges(spark, folder))


def raw_graph(spark, folder):
    return stored_once(spark, f"raw{folder}", lambda: star_graph(spark, folder, edges(spark, folder)), sites=False)


def merged_graph(spark, folder):
    """The sources merged as they are made; the raw graph need not be stored for it."""
    def build():
        graph = star_graph(spark, folder, edges(spark, folder))
        # A missing source is the empty one, as when a stored graph is read.
        named = lambda df, column: df.withColumn(column, F.coalesce(column, F.lit("")))
        return merge_sources(graph.with_tables(
            documents=named(graph.documents, "source"), symbols=named(graph.symbols, "symbol_source"), chunks=named(graph.chunks, "source"),
        ))

    return stored_once(spark, f"merged{folder}", build, site_buckets=TEST_BUCKETS)


def text_graph(spark, folder):
    return stored_once(
        spark, f"text{folder}", lambda: star_graph(spark, folder, edges(spark, folder), text_paths=True), site_buckets=TEST_BUCKETS,
    )


def wide_graph(spark, folder):
    """The merged graph with one document per customer, so that files have many symbols."""
    def build():
        graph = merged_graph(spark, folder)
        owner = table(spark, folder, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_custkey").alias("_owner"))
        moved = lambda df: df.join(owner, "doc_id").withColumn("doc_id", F.col("_owner")).select(*df.columns)
        path = F.concat("source", F.lit("/customer_"), F.col("doc_id").cast("string"), F.lit(".go"))
        documents = moved(graph.documents).select("source", "doc_id").distinct().withColumn("relative_path", path)
        return graph.with_tables(documents=documents, chunks=moved(graph.chunks), definition_ranges=moved(graph.definition_ranges))

    return stored_once(spark, f"wide{folder}", build, site_buckets=TEST_BUCKETS)


def text_lines(spark, folder):
    return stored_table(spark, f"lines{folder}", lambda: source_lines(text_files(spark, folder)))


def occurrences(spark, folder):
    def build():
        known = edges(spark, folder)
        return star_inputs.star_occurrences(named_edges(spark, folder, known), known.count())

    return stored_table(spark, f"occurrences{folder}", build)


def symbol_info(spark, folder):
    def build():
        made = occurrences(spark, folder)
        return star_inputs.star_symbol_info(made, made.count())

    return stored_table(spark, f"info{folder}", build)


def k8s_objects(spark, folder):
    return stored_table(spark, f"objects{folder}", lambda: star_inputs.k8s_objects(spark, folder))


def proto_tables(spark, folder):
    """Made from the stored edges as they are read: short rows and cheap, but fourteen spans a line."""
    return star_inputs.proto_tables(edges(spark, folder))


def terraform_tables(spark, folder):
    made = star_inputs.terraform_tables
    return (
        stored_table(spark, f"responses{folder}", lambda: made(edges(spark, folder))[0]),
        stored_table(spark, f"uses{folder}", lambda: made(edges(spark, folder))[1]),
    )
