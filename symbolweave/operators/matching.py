"""Many patterns against many strings without comparing every pair.

A pattern ``%name%`` can only match a text that holds every literal run of the name. One
run is cut to a gram, texts are spread into the grams of the lengths in use, the two meet
in an equi join, and the full pattern is checked on the pairs that are left. Prefix
patterns meet on a leading piece in the same way.
"""

from pyspark.sql import DataFrame, functions as F

from ..functions import text
from ..graph import SYMBOL_KEY
from ..plans.sizing import hinted, profile
from ..sources.indexes import bucket_of, grams_of, parts_of_prefix

GRAM_LENGTHS = (0, 1, 2, 3, 5, 8, 12)
PREFIX_LENGTHS = (0, 1, 2, 4, 8, 12, 16, 24, 32, 48, 64, 96, 128)
# Sub-keys per gram when the patterns are too many to broadcast: a gram that most texts
# hold is then met by this many tasks.
GRAM_SALTS = 32


def _class_of(length, lengths):
    """Largest supported length that is not above ``length``."""
    chosen = F.lit(lengths[0])
    for size in lengths[1:]:
        chosen = F.when(length >= size, size).otherwise(chosen)
    return chosen


def _anchored(queries, name, match):
    """Queries with the longest literal run of the pattern and the gram taken from its end."""
    lowered = text.ascii_lower(F.col(name))
    runs = F.split(lowered, "[%_]", -1) if match == "like" else F.array(lowered)
    longest = F.aggregate(
        runs, F.lit(""), lambda best, run: F.when(F.length(run) > F.length(best), run).otherwise(best),
    )
    anchored = queries.filter(F.col(name).isNotNull()).withColumn("_run", longest)
    anchored = anchored.withColumn("_class", _class_of(F.length("_run"), GRAM_LENGTHS))
    return anchored.withColumn(
        "_gram", F.expr("substring(_run, length(_run) - _class + 1, _class)"),
    ).drop("_run")


def _accepts(value, name, match):
    lowered, pattern = text.ascii_lower(value), text.ascii_lower(name)
    literal = F.contains(lowered, pattern)
    if match == "literal":
        return literal
    return F.when(name.rlike("[%_]"), text.symbol_like(value, name)).otherwise(literal)


def match_substring(texts: DataFrame, column: str, queries: DataFrame, name="name", match="like") -> DataFrame:
    """Pairs of text rows and queries whose name occurs in ``column``, each pair once.

    ``match='like'`` reads ``%`` and ``_`` in the name as wildcards, ``'literal'`` does not.
    """
    if match not in ("like", "literal"):
        raise ValueError(f"match must be 'like' or 'literal', got {match!r}")
    patterns = _anchored(queries, name, match)
    stats = profile(patterns, "_class")
    lengths = stats.classes or (0,)

    lowered = texts.withColumn("_low", text.ascii_lower(F.col(column)))
    # Every piece of the lengths in use; length 0 (a pattern of wildcards only) gives one row.
    last_start = F.when(F.col("_class") == 0, 1).otherwise(F.length("_low") - F.col("_class") + 1)
    spread = (
        lowered.withColumn("_class", F.explode(F.array(*[F.lit(n) for n in lengths])))
        .filter(F.length("_low") >= F.col("_class"))
        .withColumn("_at", F.explode(F.sequence(F.lit(1), last_start)))
        .withColumn("_gram", F.expr("substring(_low, _at, _class)"))
    )
    keys = ["_class", "_gram"]
    if not stats.small:
        spread = spread.withColumn("_salt", F.pmod(F.xxhash64(column), F.lit(GRAM_SALTS)).cast("int"))
        patterns = patterns.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(GRAM_SALTS - 1))))
        keys = keys + ["_salt"]
    pairs = spread.join(hinted(patterns, stats.small), keys)
    # A gram that repeats inside one text gives the pair again; only its first place counts.
    first_place = (F.col("_class") == 0) | (F.expr("locate(_gram, _low)") == F.col("_at"))
    pairs = pairs.filter(first_place & _accepts(F.col(column), F.col(name), match)).select(
        *texts.columns, *[c for c in queries.columns if c not in texts.columns],
    )
    return pairs, stats


def match_indexed(graph, queries: DataFrame, name="name", match="like"):
    """The pairs of ``match_substring`` from a graph's stored pieces, and the measured number of queries.

    Every literal run of a name is cut into pieces; of those the rarest, by the stored counts, is looked up in its
    partition, and a name with a piece that no moniker holds is done. The symbols found are joined to their monikers
    last and checked with the full pattern. Names without a run of a piece's length read all monikers, as without an index.
    """
    if match not in ("like", "literal"):
        raise ValueError(f"match must be 'like' or 'literal', got {match!r}")
    indexes = graph.indexes
    lowered = text.ascii_lower(F.col(name))
    runs = F.split(lowered, "[%_]", -1) if match == "like" else F.array(lowered)
    pieces = F.array_distinct(F.flatten(F.transform(runs, grams_of)))
    asked = queries.filter(F.col(name).isNotNull()).withColumn("_pieces", pieces).withColumn("_short", F.size("_pieces") == 0)
    stats = profile(asked.drop("_pieces"), "_short")
    texts = graph.symbols.select(*SYMBOL_KEY, "symbol")
    found = None
    if True in stats.classes:
        found, _ = match_substring(texts, "symbol", asked.filter("_short").select(*queries.columns), name, match)
    if False in stats.classes or found is None:
        names = asked.filter(~F.col("_short")).select(F.col(name).alias("_name"), "_pieces").distinct()
        spread = names.select("_name", F.explode("_pieces").alias("gram")).withColumn("gram_bucket", bucket_of(F.col("gram"), indexes.buckets))
        counted = indexes.gram_counts.join(hinted(spread, stats.small), ["gram_bucket", "gram"], "right")
        rarest = counted.groupBy("_name").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "gram_bucket")).alias("r"))
        probes = rarest.filter("r.n > 0").select("_name", "r.gram", "r.gram_bucket")
        held = indexes.grams.join(hinted(probes, stats.small), ["gram_bucket", "gram"]).select("_name", *SYMBOL_KEY)
        pairs = held.join(texts, SYMBOL_KEY).filter(_accepts(F.col("symbol"), F.col("_name"), match))
        whole = queries.join(pairs.withColumnRenamed("_name", name), name).select(
            *texts.columns, *[c for c in queries.columns if c not in texts.columns],
        )
        found = whole if found is None else found.unionByName(whole)
    return found, stats


def match_names(graph, queries: DataFrame, name="name"):
    """Pairs of symbols and queries whose name is exactly the display name, and the measured number of queries.

    With the stored names only the partitions of the names asked for are read.
    """
    stats = profile(queries)
    small = hinted(queries.filter(F.col(name).isNotNull()), stats.small)
    if graph.indexes is None:
        named = graph.named_symbols()
        pairs = named.join(small, named["display_name"] == small[name])
    else:
        asked = small.withColumn("name_bucket", bucket_of(F.col(name), graph.indexes.buckets))
        named = graph.indexes.names.withColumnRenamed("name_bucket", "_bucket")
        pairs = named.join(asked, (named["_bucket"] == asked["name_bucket"]) & (named["display_name"] == asked[name]))
    columns = [*SYMBOL_KEY, "symbol"]
    return pairs.select(*columns, *[c for c in queries.columns if c not in columns]), stats


def match_prefix(texts: DataFrame, column: str, queries: DataFrame, scope="scope", boundary=False, splits=None) -> DataFrame:
    """Pairs of text rows and queries whose scope is a prefix of ``column``.

    ``splits`` are those of a table in the order of ``column`` with a ``path_part``: then only the parts that can hold
    the literal start of a scope are read.
    """
    stem = F.rtrim(F.col(scope), F.lit("/"))
    literal = F.element_at(F.split(text.ascii_lower(stem), "[%_]", -1), 1)
    patterns = (
        queries.filter(F.col(scope) != "")
        .withColumn("_class", _class_of(F.length(literal), PREFIX_LENGTHS))
        .withColumn("_lead", F.substring(literal, F.lit(1), F.col("_class")))
    )
    stats = profile(patterns, "_class")
    lengths = stats.classes or (0,)
    spread = texts.withColumn("_class", F.explode(F.array(*[F.lit(n) for n in lengths]))).withColumn(
        "_lead", F.substring(text.ascii_lower(F.col(column)), F.lit(1), F.col("_class")),
    )
    keys = ["_class", "_lead"]
    if splits is not None:
        # Saying that parts count from zero tells the planner that those asked for are worth selecting.
        patterns = patterns.withColumn("path_part", F.explode(parts_of_prefix(splits, literal))).filter("path_part >= 0")
        keys = ["path_part", *keys]
    if not stats.small:
        spread = spread.withColumn("_salt", F.pmod(F.xxhash64(column), F.lit(GRAM_SALTS)).cast("int"))
        patterns = patterns.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(GRAM_SALTS - 1))))
        keys = keys + ["_salt"]
    pairs = spread.join(hinted(patterns, stats.small), keys)
    return pairs.filter(text.path_prefix(F.col(column), F.col(scope), boundary)).select(
        *texts.columns, *[c for c in queries.columns if c not in texts.columns],
    )
