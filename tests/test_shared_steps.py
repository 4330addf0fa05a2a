"""The steps that every query of a stored star graph shares: edges, names, and the joins behind the edge tables."""

import re

from conftest import rows

from symbolweave.catalog import inputs
from symbolweave.graph import CodeGraph
from symbolweave.operators.merge import merge_sources
from symbolweave.plans import sizing
from symbolweave.sources import star_inputs, starschema, store


def _tables(spark, folder):
    """Parts 1 and 2 share a name, part 3 has two, part 4 none; lines repeat, name unknown parts or none."""
    write = lambda name, fields, made: spark.createDataFrame(made, fields).write.parquet(f"{folder}/{name}.parquet")
    write("part", "p_partkey long, p_name string, p_brand string, p_type string, p_size int", [
        (1, "a b", "B#1", "T", 1), (2, "a b", "B#1", "T", 1), (3, "c", "B#1", "T", 1), (3, "d", "B#1", "T", 1), (4, "e", None, "T", 1),
    ])
    write("orders", "o_orderkey long, o_custkey long, o_orderpriority string, o_orderstatus string", [
        (1, 5, "1-URGENT", "F"), (2, 6, "2-HIGH", "O"), (3, None, "2-HIGH", "O"),
    ])
    write("lineitem", "l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string, l_linestatus string", [
        (1, 1, 1, "R", "F"), (1, 1, 2, "R", "F"), (1, 1, 2, "R", "F"), (1, 1, 3, "A", "F"), (1, 2, 4, "A", "F"), (1, 3, 9, "A", "F"),
        (2, 1, 2, "R", "O"), (2, 2, None, "R", "O"), (3, 1, 1, "A", "F"), (9, 1, 1, "A", "F"),
    ])
    return str(folder)


def test_edges_hold_no_moniker_and_mark_lines_and_names_once(spark, tmp_path):
    edges = starschema.star_edges(spark, _tables(spark, tmp_path))
    assert "symbol" not in edges.columns
    line = ["source", "doc_id", "l_linenumber"]
    assert rows(edges.filter("leads_line"), *line) == rows(edges.select(*line).distinct())
    name = [*line, "first_part", "nth_name", "role"]
    assert rows(edges.filter("leads_name"), *name) == rows(edges.select(*name).distinct())


def test_a_star_graph_names_parts_by_the_smallest_of_a_name(spark, tmp_path):
    graph = starschema.star_graph(spark, _tables(spark, tmp_path))
    moniker = lambda name: f"scip-go gomod github.com/org/B-1 v1 `github.com/org/t`/{name}#"
    assert rows(graph.symbols, "symbol_source", "symbol_id", "symbol") == rows(spark.createDataFrame([
        (None, 1, moniker("a_b")), ("repo-0", 1, moniker("a_b")), ("repo-0", 3, moniker("c")), ("repo-0", 3, moniker("d")),
        ("repo-0", 4, None), ("repo-0", 4, None), ("repo-1", 2, moniker("a_b")),  # once per name of the part below it
    ], "a string, b long, c string"))
    assert rows(graph.mentions, "source", "chunk_id", "symbol_id", "role") == [
        ("repo-0", 11, 1, 1), ("repo-0", 11, 3, 8), ("repo-1", 21, 2, 17)]
    assert rows(graph.chunks, "source", "chunk_id") == [(None, 31), ("repo-0", 11), ("repo-0", 12), ("repo-1", 21)]


def test_monikers_join_last(make_graph):
    """Only what is joined last carries the moniker; before, every shuffle of the edges did."""
    graph = make_graph(documents=[(1, "a.go", None)], symbols=[(1, "x")], chunks=[(1, 1, 0, 9)], mentions=[(1, 1, 0)])
    plan = graph.sites()._jdf.queryExecution().executedPlan().toString()
    joins = re.findall(r"SortMergeJoin \[([^\]]*)\]", plan)
    assert joins[0].startswith("symbol_source") and len(joins) == 3
    assert rows(graph.sites(), "symbol", "relative_path", "start_line", "end_line", "role") == [("x", "a.go", 0, 9, 0)]


def test_sites_are_joined_once(spark, make_graph, tmp_path, monkeypatch):
    """The table by file is read from the table by symbol."""
    asked, own = [], CodeGraph.sites
    monkeypatch.setattr(CodeGraph, "sites", lambda graph: asked.append(1) or own(graph))
    written, write = {}, store._write_bucketed
    def kept(table, folder, *rest):
        written[folder.rsplit("/", 1)[1]] = table._jdf.queryExecution().analyzed().toString()
        write(table, folder, *rest)
    monkeypatch.setattr(store, "_write_bucketed", kept)
    graph = make_graph(documents=[(1, "a.go", None)], symbols=[(1, "x")], chunks=[(1, 1, 0, 9)], mentions=[(1, 1, 0)])
    store.write_graph(graph, f"{tmp_path}/g", site_buckets=2)
    assert "Join" not in written["file_sites"] and asked
    assert rows(store.load_graph(spark, f"{tmp_path}/g").stored_file_sites, "symbol", "relative_path") == [("x", "a.go")]


def test_the_merged_graph_is_that_of_the_stored_sources(spark, tmp_path):
    """It is merged without storing them, and orders without a customer, whose source is missing, change nothing."""
    folder = _tables(spark, tmp_path)
    store.write_graph(merge_sources(inputs.raw_graph(spark, folder)), f"{tmp_path}/merged", site_buckets=2)
    expected, found = store.load_graph(spark, f"{tmp_path}/merged"), inputs.merged_graph(spark, folder)
    assert rows(expected.sites(), "source", "role") == [
        ("repo-0", 1), ("repo-0", 8), ("repo-0", 8), ("repo-1", 17)]  # the part of two names is two symbols of one id
    for name in ("documents", "symbols", "chunks", "mentions", "definition_ranges"):
        assert rows(getattr(found, name)) == rows(getattr(expected, name))
    assert rows(found.sites().drop("symbol_bucket")) == rows(expected.sites().drop("symbol_bucket"))
    assert rows(found.stored_file_sites.drop("file_bucket")) == rows(expected.stored_file_sites.drop("file_bucket"))


def test_tasks_grow_with_the_rows(spark, tmp_path, monkeypatch):
    """Edges and occurrences were gathered by compressed bytes, so that a task's memory grew with the tables."""
    folder = _tables(spark, tmp_path)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    few = starschema.star_edges(spark, folder)
    assert "REPARTITION_BY_NUM" not in plan(few)
    monkeypatch.setattr(sizing, "ROWS_PER_TASK", 1)
    many = starschema.star_edges(spark, folder)
    assert re.findall(r"hashpartitioning\(doc_id#\w+, (\d+)\), REPARTITION_BY_NUM", plan(many)) == ["10", "10"]  # ten lines
    assert rows(many) == rows(few)
    named = starschema.named_edges(spark, folder, many)
    made = star_inputs.star_occurrences(named, 9)
    assert re.search(r"hashpartitioning\(source#\w+, relative_path#\w+, 9\), REPARTITION_BY_NUM", plan(made))
    assert rows(made) == rows(star_inputs.star_occurrences(named))
    made.write.parquet(f"{tmp_path}/occurrences")
    stored = spark.read.parquet(f"{tmp_path}/occurrences")
    info = star_inputs.star_symbol_info(stored, 9)
    assert "REPARTITION_BY_NUM" in plan(info)
    assert rows(info) == rows(star_inputs.star_symbol_info(stored))
