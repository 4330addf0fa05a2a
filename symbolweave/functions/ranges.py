"""Line and character ranges, windows and rendered locations. Lines are 0-based."""

from pyspark.sql import Column, functions as F

from ..constants import GREP_MAX_BODY_LINES, GREP_MAX_CONTEXT


def _at(array, index):
    return F.get(array, F.lit(index))


def normalise_range(rng: Column) -> Column:
    """Three- or four-element range array -> struct of four bounds; anything else is null."""
    three, four = F.size(rng) == 3, F.size(rng) == 4
    return F.when(
        three | four,
        F.struct(
            _at(rng, 0).alias("start_line"),
            _at(rng, 1).alias("start_char"),
            F.when(three, _at(rng, 0)).otherwise(_at(rng, 2)).alias("end_line"),
            F.when(three, _at(rng, 2)).otherwise(_at(rng, 3)).alias("end_char"),
        ),
    )


def span_to_range(span: Column) -> Column:
    """Single-line token span -> struct(start_line, start_char, end_char); otherwise null."""
    bounds = normalise_range(span)
    return F.when(
        bounds["start_line"] == bounds["end_line"],
        F.struct(
            bounds["start_line"].alias("start_line"), bounds["start_char"].alias("start_char"),
            bounds["end_char"].alias("end_char"),
        ),
    )


def lsp_range(start_line: Column, start_char: Column, end_line: Column, end_char: Column) -> Column:
    """End character of a declaration; one past the start when the range leaves its line."""
    return F.when(end_line == start_line, end_char).otherwise(start_char + 1)


def invalid_enclosing_range(rng: Column) -> Column:
    bounds = normalise_range(rng)
    ends_early = (bounds["end_line"] < bounds["start_line"]) | (
        (bounds["end_line"] == bounds["start_line"]) & (bounds["end_char"] < bounds["start_char"])
    )
    return F.coalesce(ends_early, F.lit(False))


def render_location(file: Column, start_line: Column, end_line: Column, start_char: Column) -> Column:
    return (
        F.when(start_char.isNotNull(), F.concat_ws(":", file, start_line, start_char))
        .when(start_line == end_line, F.concat_ws(":", file, start_line))
        .otherwise(F.concat(file, F.lit(":"), start_line, F.lit("-"), end_line))
    )


def line_in_chunk(line: Column, start_line: Column, end_line: Column) -> Column:
    return line.between(start_line, end_line)


def clamp_context(context: Column) -> Column:
    return F.greatest(F.lit(0), F.least(context, F.lit(GREP_MAX_CONTEXT)))


def clamp_window(start: Column, end: Column, n_lines: Column) -> Column:
    return F.struct(
        F.greatest(F.lit(0), start).alias("first_line"), F.least(n_lines - 1, end).alias("last_line"),
    )


def body_span(start_line: Column, end_line: Column, max_lines: int | None = GREP_MAX_BODY_LINES) -> Column:
    """Lines of a definition body to show, and whether the body goes on past them; ``None`` shows it whole."""
    if max_lines is None:
        return F.struct(start_line.alias("first_line"), end_line.alias("last_line"), F.lit(False).alias("truncated"))
    too_long = (end_line - start_line + 1) > max_lines
    return F.struct(
        start_line.alias("first_line"),
        F.when(too_long, start_line + (max_lines - 1)).otherwise(end_line).alias("last_line"),
        too_long.alias("truncated"),
    )


def symbol_range(location: Column, selection: Column, full: Column) -> Column:
    return F.coalesce(location, selection, full)
