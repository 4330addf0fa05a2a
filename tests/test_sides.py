"""Sides of joins that the planner would broadcast by the size of their files, or that were measured too small."""

from conftest import rows
from pyspark.sql import functions as F

from symbolweave.operators import files, protobuf, terraform


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(df, tmp_path, name):
    df.write.parquet(f"{tmp_path}/{name}")
    return df.sparkSession.read.parquet(f"{tmp_path}/{name}")


_POINT = "struct<line:int,character:int>"


def test_uses_in_small_files_are_not_broadcast(frame, tmp_path):
    point = {"line": 1, "character": 2}
    uses = stored(frame(
        f"source string, uri string, line int, character int, target_uri string, target_range struct<start:{_POINT},end:{_POINT}>",
        [("s", "file:///w/a.tf", 0, 0, "file:///w/b.tf", {"start": point, "end": point})] * 2,
    ), tmp_path, "uses")
    declared = stored(frame(
        "source string, uri string, line int, character int, symbol string",
        [("s", "file:///w/a.tf", 0, 0, "x"), (None, "file:///w/a.tf", 0, 0, "y")],
    ), tmp_path, "declared")
    found = terraform.terraform_references(declared, uses, "/w")
    assert "Broadcast" not in plan_of(found)
    assert rows(found) == [("s", "b.tf", "x", [1, 2, 2])] * 2


def test_scopes_in_small_files_are_not_broadcast(frame):
    fields = ("source string, file string, package string, path array<int>, kind string, name string, field_type int, "
              "type_name string, input_type string, output_type string")
    made = frame(fields, [
        ("s", "f", "p", [4, 0], "message", "A", None, None, None, None),
        ("s", "f", "p", [4, 0, 3, 0], "message", "B", None, None, None, None),
        ("s", "f", "p", [4, 0, 3, 0, 2, 0], "field", "c", 9, None, None, None),
    ])
    named = protobuf.enclosing_names(made)
    assert "Broadcast" not in plan_of(named)
    assert rows(named, "name", "scope") == [("A", "p"), ("B", "p/A"), ("c", "p/A/B")]


def test_a_position_counts_once_a_level(spark, make_graph):
    graph = make_graph(documents=[(1, "a.go", None)], symbols=[(1, "x")], chunks=[(1, 1, 0, 9)], mentions=[(1, 1, 0)])
    asked = lambda n: spark.range(n).select(
        F.concat(F.lit("q"), "id").alias("query_id"), F.lit("a.go").alias("file"), F.col("id").cast("int").alias("line"))
    chosen = lambda df: "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()
    assert chosen(files.symbols_at(graph, asked(100)))
    many = files.symbols_at(graph, asked(50_000))
    assert not chosen(many)
    assert many.count() == 10
