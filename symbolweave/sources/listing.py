"""Facts read from file listings: languages, targets, render roots and schema roots."""

from pyspark.sql import DataFrame, functions as F

from ..constants import (
    CODE_TARGET_TYPES, LANGUAGE_MARKERS, LANGUAGES, MAX_RENDER_ROOTS, PROTO_WORKSPACE_FILES,
)
from ..functions import paths
from ..plans.ranking import top_per_key


def detected_languages(listing: DataFrame) -> DataFrame:
    """Distinct languages of each repository, from the base names of its files."""
    name = paths.base_name(F.col("path"))
    found = F.array().cast("array<string>")
    for language in LANGUAGES:
        tests = F.lit(False)
        for owner, marker in LANGUAGE_MARKERS:
            if owner == language:
                tests = tests | (F.endswith(name, F.lit(marker[1:])) if marker.startswith("*") else name == marker)
        found = F.concat(found, F.when(tests, F.array(F.lit(language))).otherwise(F.array().cast("array<string>")))
    return listing.select("repo", F.explode(found).alias("language")).distinct()


def detect_languages(listing: DataFrame) -> DataFrame:
    """Sorted list of languages per repository; the list is bounded by the known languages."""
    return detected_languages(listing).groupBy("repo").agg(F.array_sort(F.collect_list("language")).alias("languages"))


def _requested(selections):
    return selections.select(
        "selection_id",
        F.explode(F.split(F.coalesce("langs", F.lit("")), ",", -1)).alias("token"),
    ).select("selection_id", F.lower(F.trim("token")).alias("language")).filter("language <> ''").distinct()


def _known():
    return F.array(*[F.lit(name) for name in LANGUAGES])


def select_languages(selections: DataFrame) -> DataFrame:
    """Chosen languages per ``(selection_id, langs)``; a choice of nothing known means all."""
    chosen = _requested(selections).filter(F.col("language").isin(*LANGUAGES))
    everything = (
        selections.select("selection_id").join(chosen.select("selection_id"), "selection_id", "left_anti")
        .select("selection_id", F.explode(_known()).alias("language"))
    )
    return chosen.unionByName(everything.distinct())


def unknown_languages(selections: DataFrame) -> DataFrame:
    return _requested(selections).filter(~F.col("language").isin(*LANGUAGES))


def target_subdirs(targets: DataFrame) -> DataFrame:
    """Folders to index per scan, in first-seen order; a scan without code targets uses its root.

    ``targets(scan_id, position, type, workspace_subdir)``.
    """
    folder = F.coalesce("workspace_subdir", F.lit(""))
    code = targets.filter(F.col("type").isin(*CODE_TARGET_TYPES)).groupBy(
        "scan_id", folder.alias("subdir"),
    ).agg(F.min("position").alias("position"))
    bare = targets.select("scan_id").distinct().join(code.select("scan_id"), "scan_id", "left_anti")
    return code.unionByName(bare.select("scan_id", F.lit("").alias("subdir"), F.lit(0).cast(
        dict(targets.dtypes)["position"]).alias("position")))


def render_roots(listing: DataFrame, cap: int | None = None) -> DataFrame:
    """Folders to render per repository: local kustomizations first, then own charts.

    ``listing(repo, path, remote_chart)``; a kustomization that pulls a remote chart is
    skipped and also hides a chart in the same folder. A cap per repository may be given.
    """
    folder = paths.parent_dir(F.col("path"))
    name = paths.base_name(F.col("path"))
    named = listing.select("repo", "path", folder.alias("root"), name.alias("name"), "remote_chart")
    kustomizations = named.filter("name = 'kustomization.yaml'").groupBy("repo", "root").agg(
        F.bool_or(F.coalesce("remote_chart", F.lit(False))).alias("remote"),
    )
    # A folder has templates when some file lies below its templates folder.
    inside = F.concat(F.lit("/"), F.col("path"))
    templates = listing.select("repo", inside.alias("p")).filter(F.contains(F.col("p"), F.lit("/templates/"))).select(
        "repo", F.explode(_template_owners(F.col("p"))).alias("root"),
    ).distinct()
    charts = (
        named.filter("name = 'Chart.yaml'").select("repo", "root").distinct()
        .join(templates, ["repo", "root"], "left_semi")
        .join(kustomizations.select("repo", "root"), ["repo", "root"], "left_anti")
    )
    roots = kustomizations.filter("not remote").select("repo", "root", F.lit("kustomize").alias("kind")).unionByName(
        charts.select("repo", "root", F.lit("helm").alias("kind")),
    )
    if cap is None:
        return roots
    # Kustomizations come first; within a kind, the order of the sorted marker files.
    marker = F.when(F.col("kind") == "kustomize", "kustomization.yaml").otherwise("Chart.yaml")
    parts = F.split(F.concat_ws("/", F.nullif("root", F.lit("")), marker), "/", -1)
    order = [F.col("kind").desc(), parts]
    return top_per_key(roots, ["repo"], order, cap, column="position")


def _template_owners(path):
    """Every folder above a ``templates`` folder of the path, without the leading slash."""
    parts = F.split(path, "/", -1)
    places = F.filter(
        F.sequence(F.lit(2), F.size(parts) - 1), lambda i: F.get(parts, i - 1) == "templates",
    )
    return F.transform(places, lambda i: F.array_join(F.slice(parts, F.lit(2), i - 2), "/"))


def proto_roots(listing: DataFrame) -> DataFrame:
    """Schema root per repository: a workspace file at the top, else the first one below.

    Workspace files outrank module files; the smallest (rank, path) is combined map-side.
    """
    name = paths.base_name(F.col("path"))
    rank = F.when(name == PROTO_WORKSPACE_FILES[0], 0).otherwise(1)
    place = F.struct(
        (F.when(F.contains("path", F.lit("/")), 1).otherwise(0)).alias("depth"), rank.alias("rank"),
        F.split("path", "/", -1).alias("parts"), paths.parent_dir(F.col("path")).alias("root"),
    )
    return listing.filter(name.isin(*PROTO_WORKSPACE_FILES)).groupBy("repo").agg(F.min(place).alias("first")).select(
        "repo", F.col("first.root").alias("root"),
    )
