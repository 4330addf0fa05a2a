"""Source text and ASCII-only pattern matching."""

from pyspark.sql import Column, functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Every line boundary of the Unicode line-splitting rule used for source files.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def ascii_lower(value: Column) -> Column:
    return F.translate(value, _UPPER, _UPPER.lower())


def like_ascii(value: Column, pattern: Column) -> Column:
    """``LIKE`` that folds only ASCII case and knows no escape character.

    The engine's own ``LIKE`` treats a backslash as an escape, so it is doubled first.
    """
    return F.like(ascii_lower(value), F.replace(ascii_lower(pattern), F.lit("\\"), F.lit("\\\\")))


def symbol_like(symbol: Column, name: Column) -> Column:
    return like_ascii(symbol, F.concat(F.lit("%"), name, F.lit("%")))


def path_prefix(path: Column, scope: Column, boundary: bool = False) -> Column:
    """True when ``path`` starts with ``scope``; an empty scope matches nothing.

    With ``boundary`` the scope must also end at a path separator or at the end.
    """
    stem = F.rtrim(scope, F.lit("/"))
    hit = like_ascii(path, F.concat(stem, F.lit("%")))
    if boundary:
        hit = like_ascii(path, stem) | like_ascii(path, F.concat(stem, F.lit("/%")))
    return (scope != "") & hit


def split_lines(text: Column) -> Column:
    parts = F.split(text, LINE_BREAK, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def numbered_line(line_no: Column, line: Column) -> Column:
    return F.when(line_no.isNotNull(), F.format_string("  %5d %s", line_no + 1, line))
