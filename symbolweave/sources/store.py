"""Graphs on disk: Parquet tables under one folder, written once and queried many times."""

import hashlib
import re
import uuid
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schema
from ..graph import SITE_BUCKETS, SYMBOL_KEY, CodeGraph, file_bucket, symbol_bucket
from ..operators.merge import merge_labelled
from ..plans.tables import shared_folder, side_by_side
from . import commits
from .indexes import read_indexes, write_indexes

_LAYOUT = {
    "documents": (schema.DOCUMENTS, "source", ["source", "doc_id"]),
    "symbols": (schema.SYMBOLS, "symbol_source", ["symbol_source", "symbol_id"]),
    "chunks": (schema.CHUNKS, "source", ["source", "doc_id", "chunk_index"]),
    "mentions": (schema.MENTIONS, "source", ["source", "chunk_id"]),
    "definition_ranges": (schema.DEFINITION_RANGES, "source", ["source", "doc_id"]),
}


def _write_bucketed(table, folder, column, bucket, order):
    (
        table.withColumn(column, bucket).hint("rebalance", column).sortWithinPartitions(column, *order)
        .write.mode("overwrite").partitionBy(column).parquet(folder)
    )


def write_graph(graph: CodeGraph, folder: str, sites: bool = True, site_buckets: int = SITE_BUCKETS) -> None:
    """Write the tables, partitioned by source, and with ``sites`` the edge tables, partitioned by symbol or file, and the indexes.

    The rebalance hint gathers the rows of a partition into files of the advisory size: a
    source or symbol with most of the rows is split over many tasks and files, small ones
    share a task.

    The tables go to a new version under the folder, and one renamed file makes it the current one: a graph may be read
    from the folder it is written to, and a write that fails at any point leaves the version before. Old versions stay.
    """
    pointer, folder, version = folder, *_new_version(folder)

    def write(name):
        fields, partition, order = _LAYOUT[name]
        table = getattr(graph, name)
        for field in fields.fields:
            if field.name not in table.columns:
                table = table.withColumn(field.name, F.lit(None).cast(field.dataType))
        extra = [c for c in table.columns if c not in fields.fieldNames()]
        (
            table.select(*fields.fieldNames(), *extra)
            .hint("rebalance", partition).sortWithinPartitions(*order)
            .write.mode("overwrite").partitionBy(partition).parquet(f"{folder}/{name}")
        )

    spark, splits = graph.documents.sparkSession, None
    side_by_side(spark, *[lambda name=name: write(name) for name in ("mentions", *[n for n in _LAYOUT if n != "mentions"])])
    if sites:
        stored = _open(spark, folder, graph.merged, False, site_buckets)
        by_symbol, by_file = symbol_bucket(site_buckets), file_bucket(F.col("relative_path"), site_buckets)
        _write_bucketed(stored.sites(), f"{folder}/sites", "symbol_bucket", by_symbol, SYMBOL_KEY)
        _write_bucketed(stored.definition_sites(), f"{folder}/definition_sites", "symbol_bucket", by_symbol, SYMBOL_KEY)
        columns = [name for name in schema.FILE_SITES.fieldNames() if name != "file_bucket"]
        _write_bucketed(  # joined once: the same edges, read from their first table
            _read(spark, folder, "sites", schema.SITES).select(*columns), f"{folder}/file_sites", "file_bucket", by_file,
            ["relative_path", "start_line"],
        )
        splits = write_indexes(spark, _open(spark, folder, graph.merged, True, site_buckets), f"{folder}/indexes", site_buckets)
    try:
        number, _ = commits.latest_commit(spark, f"{pointer}/properties", "graph")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        number = 0
    commits.commit(spark, f"{pointer}/properties", "graph", number + 1, {
        "merged": graph.merged, "sites": sites, "site_buckets": site_buckets, "version": version, "path_splits": splits,
    })


def _read(spark, folder, name, fields, partition=None) -> DataFrame:
    table = spark.read.schema(fields).parquet(f"{folder}/{name}")
    # The empty label is stored as the default partition and comes back as null.
    return table.withColumn(partition, F.coalesce(F.col(partition), F.lit(""))) if partition else table


def load_graph(spark: SparkSession, folder: str, merged: bool | None = None, sites: bool | None = None) -> CodeGraph:
    """Open a written graph. A missing folder is an error."""
    _, found = commits.latest_commit(spark, f"{folder}/properties", "graph")
    merged = found["merged"] if merged is None else merged
    sites = found["sites"] if sites is None else sites
    return _open(spark, f"{folder}/{found['version']}", merged, sites, found["site_buckets"], found["path_splits"])


def _new_version(folder):
    version = f"version-{uuid.uuid4().hex}"
    return f"{folder}/{version}", version


def _open(spark, folder, merged, sites, buckets, splits=None):
    tables = {name: _read(spark, folder, name, fields, part) for name, (fields, part, _) in _LAYOUT.items()}
    return CodeGraph(
        **tables, merged=merged, site_buckets=buckets,
        stored_sites=_read(spark, folder, "sites", schema.SITES) if sites else None,
        stored_file_sites=_read(spark, folder, "file_sites", schema.FILE_SITES) if sites else None,
        stored_definitions=_read(spark, folder, "definition_sites", schema.DEFINITION_SITES) if sites else None,
        indexes=read_indexes(spark, f"{folder}/indexes", buckets, splits) if sites and splits is not None else None,
    )


def existing_graphs(spark: SparkSession, sources):
    """``(label, folder, version, position)`` of the sources whose folder holds a graph, found by listing alone."""
    found = []
    for position, (label, folder) in enumerate(sources):
        numbers = [n for n, _ in commits.children(spark, f"{folder}/properties") if n.startswith("graph-")]
        if numbers:
            found.append((label, folder, position, f"{folder}/properties/{max(numbers)}"))
    if not found:
        return []
    states = spark.read.text([path for *_, path in found], wholetext=True).select("value", "_metadata.file_path")
    version = F.get_json_object("value", "$.version")
    # One short row per source.
    rows = states.select(F.regexp_extract("file_path", "^(?:file:)?/*(.*)/properties/[^/]*$", 1), version).collect()
    by_folder = {unquote(folder).strip("/"): version for folder, version in rows}
    plain = lambda folder: re.sub("^file:", "", folder).strip("/")
    return [(label, folder, by_folder[plain(folder)], position) for label, folder, position, _ in found]


def union_sources(spark: SparkSession, sources) -> CodeGraph:
    """Merge the sources that exist; one alone passes through, none is an error.

    Each table of all sources is one scan of all their folders. A file's path says by its version folder which source
    graph it belongs to, and by its partition which source, so the plan is the same for five and for five thousand.
    """
    found = existing_graphs(spark, sources)
    if not found:
        raise ValueError("no source graphs to merge")
    if len(found) == 1:
        return load_graph(spark, found[0][1])
    labels = spark.createDataFrame([(v, label, place) for label, _, v, place in found], "_version string, _label string, _position int")

    def table(name):
        fields, partition, _ = _LAYOUT[name]
        own = T.StructType([f for f in fields.fields if f.name != partition])
        files = spark.read.schema(own).option("recursiveFileLookup", "true").parquet(
            *[f"{folder}/{version}/{name}" for _, folder, version, _ in found],
        )
        place = F.col("_metadata.file_path")
        # Written as a folder's name and read from a path, so decoded twice; a plus is a plus.
        plain = lambda c: F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
        value = F.nullif(F.regexp_extract(place, f"/{partition}=([^/]*)/", 1), F.lit("__HIVE_DEFAULT_PARTITION__"))
        marked = files.withColumns({
            "_version": F.regexp_extract(place, "/(version-[0-9a-f]+)/", 1), partition: F.coalesce(plain(plain(value)), F.lit("")),
        })
        return marked.join(labels, "_version").select(*fields.fieldNames(), "_label", "_position")

    return merge_labelled(CodeGraph(**{name: table(name) for name in _LAYOUT}))


_STORED = {}


def folder_once(spark, name, write):
    """Folder of a table set written once per application under the shared folder."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _STORED:
        base = f"{shared_folder(spark)}/symbolweave/{spark.sparkContext.applicationId}"
        folder = f"{base}/{name.strip('/').replace('/', '_')}-{hashlib.sha1(name.encode()).hexdigest()[:12]}"
        write(folder)
        _STORED[key] = folder
    return _STORED[key]


def stored_once(spark: SparkSession, name: str, build, **options) -> CodeGraph:
    """Build and write a graph once per application, then read it back.

    The written table cuts the lineage: a lost executor re-reads files instead of
    rebuilding the graph.
    """
    return load_graph(spark, folder_once(spark, name, lambda folder: write_graph(build(), folder, **options)))


def stored_table(spark: SparkSession, name: str, build) -> DataFrame:
    """The same for a single table that several jobs read."""
    return spark.read.parquet(
        folder_once(spark, name, lambda folder: build().write.mode("overwrite").parquet(folder)),
    )
