"""Symbol monikers: ``<scheme> <manager> <package> <version> <descriptor>`` or ``local <id>``."""

from pyspark.sql import Column, functions as F

from ..constants import (
    K8S_DEFAULT_NAMESPACE, K8S_MONIKER_PREFIX, PACKAGE_SCHEMES, PROTO_MONIKER_PREFIX, TERRAFORM_KIND_SUFFIX,
    TERRAFORM_MONIKER_PREFIX,
)


def display_name(symbol: Column) -> Column:
    """Last path segment of a moniker without descriptor suffixes and backticks."""
    trimmed = F.rtrim(symbol, F.lit(".#()/"))
    return F.btrim(F.substring_index(trimmed, "/", -1), F.lit("`"))


def _tokens(symbol):
    return F.split(symbol, " ", -1)


def is_package_symbol(symbol: Column) -> Column:
    parts = _tokens(symbol)
    return (F.size(parts) >= 5) & F.get(parts, F.lit(1)).isin(*PACKAGE_SCHEMES)


def moniker_parts(symbol: Column) -> Column:
    """Struct of the five moniker fields; everything after the version is the descriptor."""
    parts = _tokens(symbol)
    descriptor = F.when(F.size(parts) >= 5, F.concat_ws(" ", F.slice(parts, F.lit(5), F.size(parts))))
    return F.struct(
        F.get(parts, F.lit(0)).alias("scheme"),
        F.get(parts, F.lit(1)).alias("manager"),
        F.get(parts, F.lit(2)).alias("package"),
        F.get(parts, F.lit(3)).alias("version"),
        descriptor.alias("descriptor"),
    )


def dedup_key(symbol: Column, label: Column) -> Column:
    """Identity of a symbol across sources: package and version do not count.

    A moniker that names no package is only unique inside its own source, so it is
    qualified by the source label.
    """
    parts = _tokens(symbol)
    blanked = F.concat_ws(
        " ", F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.lit("*"), F.lit("*"),
        F.concat_ws(" ", F.slice(parts, F.lit(5), F.size(parts))),
    )
    return (
        F.when(symbol.isNull() | (symbol == ""), symbol)
        .when(is_package_symbol(symbol), blanked)
        .otherwise(F.concat(label, F.lit("\0"), symbol))
    )


def storable_symbol(symbol: Column, label: Column) -> Column:
    return (
        F.when(symbol.isNull() | (symbol == "") | is_package_symbol(symbol), symbol)
        .otherwise(F.concat(label, F.lit("/"), symbol))
    )


def _or_default(value, default):
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def k8s_symbol(namespace: Column, kind: Column, name: Column) -> Column:
    return F.concat(
        F.lit(K8S_MONIKER_PREFIX), _or_default(namespace, K8S_DEFAULT_NAMESPACE), F.lit("/"), kind, F.lit("/"), name,
        F.lit("#"),
    )


def terraform_descriptor(name: Column, kind: Column) -> Column:
    words = F.filter(
        F.transform(F.split(name, r"\s+", -1), lambda w: F.btrim(w, F.lit('"'))), lambda w: w != "",
    )
    suffix = F.lit("/")
    for code, mark in TERRAFORM_KIND_SUFFIX.items():
        suffix = F.when(kind == code, mark).otherwise(suffix)
    return F.when(F.size(words) == 0, "unknown/").otherwise(F.concat(F.array_join(words, "/"), suffix))


def terraform_symbol(name: Column, kind: Column) -> Column:
    return F.concat(F.lit(TERRAFORM_MONIKER_PREFIX), terraform_descriptor(name, kind))


def proto_ref_descriptor(type_name: Column) -> Column:
    """``.a.b.Money`` -> ``a/b/Money#``."""
    return F.concat(F.replace(F.ltrim(type_name, F.lit(".")), F.lit("."), F.lit("/")), F.lit("#"))


def proto_symbol(kind: Column, scope: Column, name: Column) -> Column:
    """Moniker of a declaration; ``scope`` is the joined package and enclosing names."""
    own = F.concat_ws("/", F.nullif(scope, F.lit("")), name)
    descriptor = (
        F.when(kind.isin("field", "value"), F.concat(scope, F.lit("#"), name, F.lit(".")))
        .when(kind == "method", F.concat(scope, F.lit("#"), name, F.lit("().")))
        .otherwise(F.concat(own, F.lit("#")))
    )
    return F.concat(F.lit(PROTO_MONIKER_PREFIX), descriptor)


def proto_ref_symbol(type_name: Column) -> Column:
    return F.concat(F.lit(PROTO_MONIKER_PREFIX), proto_ref_descriptor(type_name))
