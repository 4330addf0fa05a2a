"""Paths: labels, workspace checks and conversion of file URIs."""

import posixpath

from pyspark.sql import Column, functions as F


def repo_of(path: Column) -> Column:
    return F.when(F.contains(path, F.lit("/")), F.substring_index(path, "/", 1)).otherwise("<root>")


def prefix_path(label: Column, path: Column) -> Column:
    return F.when(label == "", path).otherwise(F.concat(label, F.lit("/"), path))


def snapshot_path(repo: Column, head_sha: Column) -> Column:
    return F.concat_ws("/", repo, head_sha)


def rendered_path(root: Column) -> Column:
    """Synthetic document of a rendered manifest root; the target itself is ``.``."""
    return F.concat(F.coalesce(F.nullif(root, F.lit("")), F.lit(".")), F.lit("/__rendered__.yaml"))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_dir(path: Column) -> Column:
    """Directory part; empty for a path without a slash."""
    return F.regexp_extract(path, "(?s)^(.*)/[^/]*$", 1)


def path_inside_workspace(path: Column) -> Column:
    """True for a relative path whose ``..`` segments never climb above the root."""
    steps = F.transform(
        F.split(path, "/", -1),
        lambda part: F.when(part == "..", -1).when(part.isin("", "."), 0).otherwise(1),
    )
    lowest = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("depth"), F.lit(0).alias("low")),
        lambda acc, step: F.struct(
            (acc["depth"] + step).alias("depth"), F.least(acc["low"], acc["depth"] + step).alias("low"),
        ),
        lambda acc: acc["low"],
    )
    return ~F.startswith(path, F.lit("/")) & (lowest >= 0)


def normalise_path(path: Column) -> Column:
    """Absolute path with ``.``, ``..`` and empty segments resolved.

    Most paths hold none of them and are returned without being taken apart.
    """
    empty = F.array().cast("array<string>")
    parts = F.aggregate(
        F.split(path, "/", -1),
        empty,
        lambda acc, part: F.when(part.isin("", "."), acc)
        .when(part == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(part))),
    )
    plain = F.startswith(path, F.lit("/")) & ~path.rlike(r"/\.{0,2}(/|$)")
    return F.when(plain, path).otherwise(F.concat(F.lit("/"), F.array_join(parts, "/")))


def relative_to_root(path: Column, root: str) -> Column:
    """Path relative to ``root``; a path outside the root keeps only its base name."""
    full, base = normalise_path(path), posixpath.normpath("/" + root.lstrip("/"))
    prefix = base if base == "/" else base + "/"
    return (
        F.when(full == base, ".")
        .when(F.startswith(full, F.lit(prefix)), F.substring(full, F.lit(len(prefix) + 1), F.length(full)))
        .otherwise(base_name(F.rtrim(path, F.lit("/"))))
    )


def uri_to_path(uri: Column) -> Column:
    """Decoded path of a ``file://`` URI; null for other schemes."""
    raw = F.regexp_extract(uri, "(?s)^file://[^/?#]*([^?#]*)", 1)
    decoded = F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when(F.startswith(uri, F.lit("file://")), F.coalesce(decoded, raw))
