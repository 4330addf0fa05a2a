"""Classification of message-type references as producer or consumer sites."""

import re
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from ..constants import CONSUMER, DEFINITION, PRODUCER, RECOGNIZER_DEFAULTS, UNKNOWN

_DEFAULT = {key: tuple(values) for key, values in RECOGNIZER_DEFAULTS.items()}


@dataclass(frozen=True)
class Recognizers:
    """Five token lists. A list given by the user replaces the default list."""

    produce: tuple = _DEFAULT["produce"]
    consume: tuple = _DEFAULT["consume"]
    produce_paths: tuple = _DEFAULT["produce_paths"]
    consume_paths: tuple = _DEFAULT["consume_paths"]
    definition_markers: tuple = _DEFAULT["definition_markers"]


def recognizers_from_json(raw: Column) -> Column:
    """Token lists from a configuration text; any unusable part keeps its default."""
    doc = F.try_parse_json(raw)
    fields = []
    for key, default in _DEFAULT.items():
        item = F.try_variant_get(doc, f"$.{key}", "variant")
        strings = F.try_variant_get(doc, f"$.{key}", "array<string>")
        shape = F.schema_of_variant(item)
        usable = (shape == "ARRAY<STRING>") & ~F.exists(strings, lambda s: s.isNull()) | (F.size(strings) == 0)
        value = F.when(usable, F.transform(strings, F.lower))
        fields.append(F.coalesce(value, F.array(*[F.lit(token) for token in default])).alias(key))
    return F.struct(*fields)


def token_hits(names: Column, tokens) -> Column:
    """How many tokens start a word in the lower-cased text. ``unmarshal`` holds no ``marshal``.

    Tokens known when the query is written become fixed patterns, compiled once per task.
    A column of tokens is matched with patterns made per row.
    """
    if isinstance(tokens, Column):
        quoted = lambda t: F.concat(
            F.lit(r"(?<![a-z0-9])\Q"), F.replace(t, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"),
        )
        return F.size(F.filter(tokens, lambda t: F.regexp_like(names, quoted(t))))
    total = F.lit(0)
    for token in tokens:
        total = total + names.rlike("(?<![a-z0-9])" + re.escape(token)).cast("int")
    return total


def _contains_any(value, fragments):
    if isinstance(fragments, Column):
        return F.exists(fragments, lambda f: F.contains(value, f))
    found = F.lit(False)
    for fragment in fragments:
        found = found | F.contains(value, F.lit(fragment))
    return found


def classify_counts(path: Column, produced: Column, consumed: Column, rec) -> Column:
    """Role of a reference site from the tokens of each side found there; directory names decide only a tie."""
    get = (lambda key: rec[key]) if isinstance(rec, Column) else (lambda key: getattr(rec, key))
    where = F.lower(F.coalesce(path, F.lit("")))
    return (
        F.when(_contains_any(where, get("definition_markers")), DEFINITION)
        .when(consumed > produced, CONSUMER)
        .when(produced > consumed, PRODUCER)
        .when(_contains_any(where, get("consume_paths")), CONSUMER)
        .when(_contains_any(where, get("produce_paths")), PRODUCER)
        .otherwise(UNKNOWN)
    )


def classify_site(path: Column, co_names: Column, rec) -> Column:
    """Role of a reference site from the display names found in the same chunk.

    ``rec`` is ``Recognizers`` or a struct column.
    """
    get = (lambda key: rec[key]) if isinstance(rec, Column) else (lambda key: getattr(rec, key))
    blob = F.lower(F.array_join(co_names, " "))
    return classify_counts(path, token_hits(blob, get("produce")), token_hits(blob, get("consume")), rec)


def tokens_found(name: Column, tokens) -> Column:
    """How many tokens start a word in some name of a group: an aggregate of one flag per token, no list of names."""
    total = F.lit(0)
    for token in tokens:
        hit = F.max(F.lower(name).rlike("(?<![a-z0-9])" + re.escape(token)))
        total = total + F.coalesce(hit, F.lit(False)).cast("int")
    return total
