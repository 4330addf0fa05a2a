"""Which repositories produce and which consume a shared message type."""

from pyspark.sql import DataFrame, functions as F

from ..constants import CONSUMER, EVENT_FLOW_LIMIT, PRODUCER
from ..functions import events, paths, ranges
from ..functions.events import Recognizers
from ..graph import CodeGraph
from ..plans.ranking import top_per_key
from ..plans.tables import written
from .files import symbols_at
from .lookup import find_references


def site_evidence(graph: CodeGraph, sites: DataFrame, rules: Recognizers, per_site: int | None = None) -> DataFrame:
    """Tokens of each side among the display names next to each distinct site, as counts.

    All symbols of the chunks at a site count, unless ``per_site`` cuts them, first by moniker. A token is a flag of the
    aggregate, so a site with very many symbols is combined before it is shuffled and no list is made.
    """
    positions = sites.select("file", F.col("start_line").alias("line")).distinct().withColumn(
        "query_id", F.concat_ws("\0", "file", "line"),
    )
    found = symbols_at(graph, positions, limit=per_site, measure=False)
    return found.groupBy("file", F.col("line").alias("start_line")).agg(
        events.tokens_found(F.col("display_name"), rules.produce).alias("produced"),
        events.tokens_found(F.col("display_name"), rules.consume).alias("consumed"),
    )


def _rules(recognizers):
    """Token lists as plain values, so that they become fixed patterns of the plan."""
    if isinstance(recognizers, DataFrame):
        row = recognizers.select("recognizers.*").first()
        return Recognizers(**{key: tuple(tokens) for key, tokens in row.asDict().items()})
    return recognizers or Recognizers()


def event_flow_sites(
    graph: CodeGraph, queries: DataFrame, recognizers=None, limit=None, per_site=None, **options,
) -> DataFrame:
    """References and definitions of each message type with their role and repository.

    ``recognizers`` is a ``Recognizers`` value or a one-row frame with a ``recognizers``
    struct column.
    """
    rules = _rules(recognizers)
    # Read twice, by the evidence and by the result, so found once.
    references = written(find_references(graph, queries, limit=limit, include_definition=True, **options), "event-references")
    evidence = site_evidence(graph, references, rules, per_site)
    sites = references.join(evidence, ["file", "start_line"], "left")
    sided = [F.coalesce(side, F.lit(0)) for side in ("produced", "consumed")]
    return sites.select(
        "query_id", "name", "symbol", "display_name", "file", "start_line", "end_line",
        events.classify_counts(F.col("file"), *sided, rules).alias("flow_role"),
        paths.repo_of(F.col("file")).alias("repo"),
        ranges.render_location(F.col("file"), F.col("start_line"), F.col("end_line"), F.col("start_char")).alias(
            "location",
        ),
    )


def role_group(role):
    return F.when(role.isin(PRODUCER, CONSUMER), role).otherwise("other")


def event_flow_by_repo(sites: DataFrame, limit: int | None = None) -> DataFrame:
    """Number of sites per message type, role group and repository.

    With a limit also a list of the first locations, at most so many; all locations are the rows of ``sites``.
    """
    keys = ["query_id", "role_group", "repo"]
    grouped = sites.withColumn("role_group", role_group(F.col("flow_role")))
    counts = grouped.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_sites"))
    if limit is None:
        return counts
    first = top_per_key(grouped, keys, [F.col("location")], limit)
    return counts.join(first.groupBy(*keys).agg(F.array_sort(F.collect_list("location")).alias("locations")), keys)


def event_flow_repos(sites: DataFrame) -> DataFrame:
    """Distinct producing and consuming repositories per message type, as rows."""
    return sites.filter(F.col("flow_role").isin(PRODUCER, CONSUMER)).select("query_id", "flow_role", "repo").distinct()


def event_flow_summary(sites: DataFrame) -> DataFrame:
    """Producing and consuming repositories per message type; the flow only if both exist.

    A list holds each repository once, so it is no longer than the number of repositories.
    """
    repos = event_flow_repos(sites)
    pick = lambda role: F.array_sort(F.collect_set(F.when(F.col("flow_role") == role, F.col("repo"))))
    grouped = repos.groupBy("query_id").agg(pick(PRODUCER).alias("producers"), pick(CONSUMER).alias("consumers"))
    both = (F.size("producers") > 0) & (F.size("consumers") > 0)
    return grouped.withColumn(
        "flow",
        F.when(both, F.concat(F.array_join("producers", ", "), F.lit(" → "), F.array_join("consumers", ", "))),
    )
