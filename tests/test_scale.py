"""Plan shapes and the ways taken by large inputs."""

import os
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as contract
from symbolweave import schema
from symbolweave.operators import files, lookup, matching
from symbolweave.plans import ranking, sizing

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def nothing_is_small(monkeypatch):
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", -1)


@pytest.fixture(scope="module")
def symbols(spark):
    words = F.array(*[F.lit(w) for w in ("alpha", "Beta_x", "gammaGamma", "d", "aaaaaaaa", "x%y")])
    at = lambda n: F.element_at(words, (F.col("id") % n + 1).cast("int"))
    return spark.range(400).select(
        F.lit("s").alias("symbol_source"), F.col("id").alias("symbol_id"),
        F.concat(at(6), F.lit("/"), at(5), F.col("id").cast("string"), F.lit("/"), at(4), F.lit("#")).alias("symbol"),
    )


NAMES = ["alpha", "ETA_", "gammagamma", "d", "", "%", "a%a", "aaaa", "aaaaaaaaa", "x%y", "/d1", "__", "BETA_X/BETA", "no such name"]


def _brute(symbols, names, match):
    """Every pair compared in plain Python."""
    found = []
    for symbol in (r["symbol"] for r in symbols.collect()):
        for name in names:
            pattern = re.escape(name.lower())
            if match == "like":
                pattern = pattern.replace("%", ".*").replace("_", ".")
            if re.search(pattern, symbol.lower(), re.S):
                found.append((name, symbol))
    return sorted(found)


@pytest.mark.parametrize("match", ["like", "literal"])
def test_pattern_join_equals_brute_force(symbols, ask, match):
    pairs, stats = matching.match_substring(symbols, "symbol", ask(*NAMES), match=match)
    assert stats.small and sorted((r["name"], r["symbol"]) for r in pairs.collect()) == _brute(symbols, NAMES, match)
    assert "NestedLoop" not in plan_of(pairs) and "Cartesian" not in plan_of(pairs)


@pytest.mark.parametrize("match", ["like", "literal"])
def test_shuffled_pattern_join_equals_brute_force(symbols, ask, match, nothing_is_small):
    pairs, stats = matching.match_substring(symbols, "symbol", ask(*NAMES), match=match)
    assert not stats.small and sorted((r["name"], r["symbol"]) for r in pairs.collect()) == _brute(symbols, NAMES, match)


SCOPES = ["alpha", "ALPHA/b", "gamma_amma/", "d/", "%/d", "", "x", "aaaaaaaa/aaaaaaaa1", "Beta_x/gammaGamma"]


def _prefix_brute(symbols, boundary):
    found = []
    for symbol in (r["symbol"] for r in symbols.collect()):
        for scope in SCOPES:
            stem = re.escape(scope.rstrip("/").lower()).replace("%", ".*").replace("_", ".")
            tail = "(/.*)?$" if boundary else ""
            if scope and re.match(stem + tail, symbol.lower(), re.S):
                found.append((scope, symbol))
    return sorted(found)


@pytest.mark.parametrize("boundary", [False, True])
@pytest.mark.parametrize("large", [False, True])
def test_prefix_join_equals_brute_force(symbols, frame, monkeypatch, boundary, large):
    if large:
        monkeypatch.setattr(sizing, "BROADCAST_ROWS", -1)
    scopes = frame(schema.SCOPES, [(s, s) for s in SCOPES])
    pairs = matching.match_prefix(symbols, "symbol", scopes, boundary=boundary)
    assert sorted((r["scope"], r["symbol"]) for r in pairs.collect()) == _prefix_brute(symbols, boundary)


LARGE = ("find_references_batch", "find_definitions", "get_imports", "symbols_at", "list_symbols", "find_implementations")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
@pytest.mark.parametrize("name", LARGE)
def test_large_query_sets_give_the_same_rows(spark, name, nothing_is_small, monkeypatch):
    large = rows(contract.queries()[name](spark, FOLDER))
    monkeypatch.undo()
    assert large == rows(contract.queries()[name](spark, FOLDER))


def test_numbering_of_a_hot_key(spark):
    """One key with most rows is numbered by many groups, in the right order."""
    df = spark.range(3000).select(
        F.when(F.col("id") < 2700, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("k"),
        (F.col("id") * 37 % 3000).alias("line"),
    )
    numbered = ranking.number_within(df, ["k"], F.floor(F.col("line") / 64), ["line"], "n")
    by_key = {}
    for row in df.collect():
        by_key.setdefault(row["k"], []).append(row["line"])
    expected = {(k, line): i for k, lines in by_key.items() for i, line in enumerate(sorted(lines))}
    assert {(r["k"], r["line"]): r["n"] for r in numbered.collect()} == expected


def test_cap_is_applied_before_the_shuffle(spark):
    df = spark.range(1000).select(F.when(F.col("id") > 9, "hot").otherwise("cold").alias("q"), "id")
    plan = plan_of(ranking.top_per_key(df, ["q"], ["id"], 5))
    assert plan.count("WindowGroupLimit") == 2 and plan.rindex("WindowGroupLimit") > plan.index("Exchange")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_lookup_scans_are_pruned(spark):
    from symbolweave.catalog.inputs import NAMES as ASKED, merged_graph, rows as queries
    plan = plan_of(lookup.find_references(merged_graph(spark, FOLDER), queries(spark, "name", ASKED)))
    assert "dynamicpruning" in plan
    by_file = spark.createDataFrame([("q", "repo-0/x.go", 3)], schema.POSITIONS)
    graph = merged_graph(spark, FOLDER)
    assert "dynamicpruning" in plan_of(files.symbols_at(graph, by_file))
    assert "dynamicpruning" in plan_of(files.get_imports(graph, by_file.drop("line")))
    assert "documentation" not in plan and "relationships" not in plan


def test_event_sites_and_positions_use_buckets(make_graph, frame):
    graph = make_graph(documents=[(1, "f", "go")], symbols=[(1, "a#"), (2, "b#")], chunks=[(1, 1, 0, 1000), (2, 1, 500, 501)],
                       mentions=[(1, 1, 8), (2, 2, 8)])
    spots = frame(schema.POSITIONS, [(str(n), "f", n) for n in (0, 499, 500, 501, 502, 1000, 1001)])
    got = rows(files.symbols_at(graph, spots), "line", "display_name")
    assert sorted(got) == [(0, "a"), (499, "a"), (500, "a"), (500, "b"), (501, "a"), (501, "b"), (502, "a"), (1000, "a")]


def test_a_very_long_chunk_is_few_rows(spark):
    from symbolweave.plans.rangejoin import LEVELS, add_interval_buckets, add_point_buckets
    spans = spark.createDataFrame([(0, 999_999), (5, 5), (63, 64), (100, 99), (0, 2_147_483_647)], "a int, b int")
    cut = add_interval_buckets(spans, F.col("a"), F.col("b"))
    counts = {(r["a"], r["b"]): r["count"] for r in cut.groupBy("a", "b").count().collect()}
    assert set(counts) == {(0, 999_999), (5, 5), (63, 64), (0, 2_147_483_647)} and max(counts.values()) <= 2
    points = spark.createDataFrame([(n,) for n in (0, 5, 63, 64, 65, 999_999, 1_000_000, 2_147_483_647)], "line int")
    places = add_point_buckets(points, F.col("line"))
    assert places.count() == 8 * len(LEVELS)
    met = places.join(cut, ["_level", "_bucket"]).filter("line BETWEEN a AND b")
    expected = [(n, a, b) for n in (0, 5, 63, 64, 65, 999_999, 1_000_000, 2_147_483_647) for a, b in counts if a <= n <= b]
    assert sorted(tuple(r) for r in met.select("line", "a", "b").collect()) == sorted(expected)


def test_numbering_of_one_line_is_spread(spark):
    """All rows of one key on one line: still many tasks, one shuffle of the rows, and the right places."""
    df = spark.range(4000).select(
        F.when(F.col("id") < 3600, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 5).cast("string"))).alias("k"),
        F.lit(1).alias("line"), (F.col("id") * 37 % 4000).alias("x"),
    )
    numbered = ranking.number_sorted(df, ["k"], ["line", "x"], "n")
    by_key = {}
    for row in df.collect():
        by_key.setdefault(row["k"], []).append(row["x"])
    expected = {(k, x): i for k, xs in by_key.items() for i, x in enumerate(sorted(xs))}
    assert {(r["k"], r["x"]): r["n"] for r in numbered.collect()} == expected
    assert numbered.select("n").rdd.getNumPartitions() >= 1 and "SortMergeJoin" not in plan_of(numbered)


def test_ids_of_spans_do_not_run_over(spark):
    df = spark.createDataFrame([("s", f"d{i}", n) for i, n in enumerate((0, 1, 1 << 30, 3, 1 << 33))], "source string, k string, size long")
    spans = ranking.add_stable_spans(df, "source", F.col("k"), F.col("size"), "span")
    ends = spans.filter("size > 0").select(
        ranking.span_id(F.col("span"), F.lit(0)).alias("a"), ranking.span_id(F.col("span"), F.col("size") - 1).alias("b"), "span.bucket")
    found = sorted((r["bucket"], r["a"], r["b"]) for r in ends.collect())
    assert all(a <= b for _, a, b in found) and all(x[2] < y[1] for x, y in zip(found, found[1:]) if x[0] == y[0])
