"""The symbol graph: five tables and, optionally, a read-optimised edge table."""

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from . import schema
from .functions import monikers
from .plans.sizing import never_broadcast

SYMBOL_KEY = ["symbol_source", "symbol_id"]
SITE_BUCKETS = 64


def file_bucket(path, buckets=SITE_BUCKETS):
    """Partition of the file-side edge table that holds a path."""
    return F.pmod(F.xxhash64(path), F.lit(buckets)).cast("int")


def symbol_bucket(buckets=SITE_BUCKETS):
    """Partition of the edge table that holds a symbol."""
    return F.pmod(F.xxhash64(*SYMBOL_KEY), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class CodeGraph:
    """Documents, symbols, chunks, mentions and definition ranges of one or more sources.

    ``merged`` says that every moniker occurs in one symbol row only. ``stored_sites`` is
    the edge table written by ``write_graph``, ``stored_file_sites`` the same edges by file
    and ``stored_definitions`` the definition ranges; without them the joins are made on
    demand. ``indexes`` are the stored tables of ``sources.indexes``, if there are any.
    """

    documents: DataFrame
    symbols: DataFrame
    chunks: DataFrame
    mentions: DataFrame
    definition_ranges: DataFrame
    merged: bool = False
    stored_sites: DataFrame | None = None
    stored_definitions: DataFrame | None = None
    stored_file_sites: DataFrame | None = None
    site_buckets: int = SITE_BUCKETS
    indexes: object | None = None

    def tables(self):
        return {
            "documents": self.documents, "symbols": self.symbols, "chunks": self.chunks,
            "mentions": self.mentions, "definition_ranges": self.definition_ranges,
        }

    def with_tables(self, **changes):
        return replace(self, stored_sites=None, stored_definitions=None, stored_file_sites=None, indexes=None, **changes)

    def sites(self) -> DataFrame:
        """Every mention with its file, line range and moniker (JOIN of the four tables).

        Monikers are the longest column and come last; equal ones lie side by side then, which a later shuffle packs well.
        """
        if self.stored_sites is not None:
            return self.stored_sites
        chunks = self.chunks.select("source", "chunk_id", "doc_id", "start_line", "end_line")
        placed = self.mentions.join(never_broadcast(chunks), ["source", "chunk_id"])
        located = placed.join(
            never_broadcast(self.documents.select("source", "doc_id", "relative_path")), ["source", "doc_id"],
        ).drop("chunk_id", "doc_id")
        return located.join(never_broadcast(self.symbols.select(*SYMBOL_KEY, "symbol")), SYMBOL_KEY).select(
            *[name for name in schema.SITES.fieldNames() if name != "symbol_bucket"],
        )

    def definition_sites(self) -> DataFrame:
        """Every precise definition range with its file and moniker."""
        if self.stored_definitions is not None:
            return self.stored_definitions
        return (
            self.definition_ranges.join(self.symbols.select(*SYMBOL_KEY, "symbol"), SYMBOL_KEY)
            .join(self.documents.select("source", "doc_id", "relative_path"), ["source", "doc_id"])
            .select(*[name for name in schema.DEFINITION_SITES.fieldNames() if name != "symbol_bucket"])
        )

    def _by_bucket(self, table, keys):
        """Join a stored table to some symbols; the bucket in the key lets the scan skip the
        partitions of all others."""
        asked = keys.withColumn("symbol_bucket", symbol_bucket(self.site_buckets))
        return table.join(asked, ["symbol_bucket", *SYMBOL_KEY]).drop("symbol_bucket")

    def _locate(self, mentions):
        return mentions.join(
            self.chunks.select("source", "chunk_id", "doc_id", "start_line", "end_line"), ["source", "chunk_id"],
        ).join(self.documents.select("source", "doc_id", "relative_path"), ["source", "doc_id"])

    def mention_sites(self, keys: DataFrame, role_filter) -> DataFrame:
        """Locations of the mentions of the symbols in ``keys``; all columns of ``keys`` stay.

        The role filter is applied to the scan. ``keys`` meets the edges first, so a small
        set of keys keeps the joins to chunks and documents small as well.
        """
        located = ["source", "relative_path", "start_line", "end_line", "role"]
        if self.stored_sites is not None:
            hits = self.stored_sites.filter(role_filter(F.col("role"))).select("symbol_bucket", *SYMBOL_KEY, *located)
            return self._by_bucket(hits, keys)
        hits = self.mentions.filter(role_filter(F.col("role"))).join(keys, SYMBOL_KEY)
        return self._locate(hits).select(*keys.columns, *located)

    def range_sites(self, keys: DataFrame) -> DataFrame:
        """Precise definition ranges of the symbols in ``keys`` with their files."""
        located = ["source", "relative_path", "start_line", "end_line", "start_char", "end_char"]
        if self.stored_definitions is not None:
            return self._by_bucket(self.stored_definitions.select("symbol_bucket", *SYMBOL_KEY, *located), keys)
        return (
            self.definition_ranges.join(keys, SYMBOL_KEY)
            .join(self.documents.select("source", "doc_id", "relative_path"), ["source", "doc_id"])
            .select(*keys.columns, *located)
        )

    def relationships(self) -> DataFrame:
        """One row per relationship that names a target."""
        return (
            self.symbols.select(*SYMBOL_KEY, "symbol", F.explode("relationships").alias("rel"))
            .filter(F.col("rel.symbol").isNotNull() & (F.col("rel.symbol") != ""))
            .select(
                *SYMBOL_KEY, "symbol", F.col("rel.symbol").alias("target"),
                F.col("rel.is_reference"), F.col("rel.is_implementation"), F.col("rel.is_type_definition"),
                F.col("rel.is_definition"),
            )
        )

    def named_symbols(self) -> DataFrame:
        """Symbols with the name derived from the moniker; the stored name column is often empty."""
        return self.symbols.select(
            *SYMBOL_KEY, "symbol", monikers.display_name(F.col("symbol")).alias("display_name"),
        )
