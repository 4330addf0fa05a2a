import os
import re

import pytest
from conftest import rows
from pyspark.errors import AnalysisException

from symbolweave.operators import files, lookup, merge
from symbolweave.sources import snapshots, store
from symbolweave import schema


@pytest.fixture(scope="module")
def pair(make_graph):
    lib, svc = "scip-go gomod lib v1 `lib/e`/Order#", "scip-go gomod svc v2 `lib/e`/Order#"
    return [
        ("lib", make_graph(documents=[(1, "e.go", "go")], symbols=[(1, lib)], chunks=[(1, 1, 0, 9)], mentions=[(1, 1, 1)],
                           ranges=[(1, 1, 2, 0, 3, 1)], source="lib")),
        ("svc", make_graph(documents=[(1, "h.go", "go")], symbols=[(1, svc)], chunks=[(1, 1, 5, 80)], mentions=[(1, 1, 8)],
                           source="svc")),
    ]


def test_round_trip_gives_the_same_answers(spark, pair, ask, frame, tmp_path):
    merged = merge.merge_graphs(pair)
    folder = f"{tmp_path}/graph"
    store.write_graph(merged, folder, site_buckets=4)
    stored = store.load_graph(spark, folder)
    assert stored.merged and stored.stored_sites is not None and stored.site_buckets == 4
    version = next(n for n in os.listdir(folder) if n.startswith("version-"))
    assert "source=lib" in os.listdir(f"{folder}/{version}/mentions")
    asked = ask("Order")
    for query in (lookup.find_definitions, lookup.find_references, lookup.resolve_symbols):
        assert rows(query(stored, asked)) == rows(query(merged, asked))
    paths = frame(schema.FILES, [("q", "svc/h.go")])
    assert rows(files.get_imports(stored, paths)) == rows(files.get_imports(merged, paths)) != []
    spots = frame(schema.POSITIONS, [("q", "svc/h.go", 70), ("r", "svc/h.go", 4)])
    assert rows(files.symbols_at(stored, spots)) == rows(files.symbols_at(merged, spots)) != []
    scopes = frame(schema.SCOPES, [("q", "LIB/"), ("r", "svc")])
    assert rows(files.list_symbols(stored, scopes)) == rows(files.list_symbols(merged, scopes)) != []
    sites = ["symbol", "relative_path", "start_line", "end_char"]
    assert rows(stored.definition_sites(), *sites) == rows(merged.definition_sites(), *sites) != []
    columns = ["symbol", "role", "relative_path", "start_line"]
    assert rows(stored.sites(), *columns) == rows(merged.sites(), *columns)


def test_empty_label_survives_storage(spark, make_graph, ask, tmp_path):
    graph = make_graph(documents=[(1, "e.go", "go")], symbols=[(1, "p/T#")], chunks=[(1, 1, 0, 9)], mentions=[(1, 1, 8)])
    store.write_graph(graph, f"{tmp_path}/g", sites=False)
    stored = store.load_graph(spark, f"{tmp_path}/g")
    assert rows(lookup.find_references(stored, ask("T")), "file", "source") == [("e.go", "")]


def test_missing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        store.load_graph(spark, f"{tmp_path}/none")


def test_union_of_existing_sources(spark, pair, tmp_path):
    for label, graph in pair:
        store.write_graph(graph, f"{tmp_path}/{label}", sites=False)
    both = store.union_sources(spark, [("lib", f"{tmp_path}/lib"), ("gone", f"{tmp_path}/gone"), ("svc", f"{tmp_path}/svc")])
    assert rows(both.documents, "relative_path") == [("lib/e.go",), ("svc/h.go",)]
    alone = store.union_sources(spark, [("gone", f"{tmp_path}/gone"), ("svc", f"{tmp_path}/svc")])
    assert rows(alone.documents, "relative_path") == [("h.go",)]
    with pytest.raises(ValueError):
        store.union_sources(spark, [("gone", f"{tmp_path}/gone")])


def test_latest_snapshot(spark, frame, tmp_path, pair):
    kind = "repo string, path string, modified timestamp"
    some = spark.createDataFrame([("r", "old", "2024-01-01"), ("r", "new", "2024-01-02"), ("s", "x", "2023-01-01")],
                                 "repo string, path string, day string").selectExpr("repo", "path", "to_timestamp(day) AS modified")
    assert rows(snapshots.latest_snapshot(some), "path") == [("new",)]
    assert rows(snapshots.latest_snapshot(some, ["repo"]), "repo", "path") == [("r", "new"), ("s", "x")]
    assert rows(snapshots.latest_snapshot(spark.createDataFrame([], kind))) == []
    store.write_graph(pair[0][1], f"{tmp_path}/root/one", sites=False)
    store.write_graph(pair[1][1], f"{tmp_path}/root/two", sites=False)
    old = 1_600_000_000
    for name in os.listdir(f"{tmp_path}/root/one/properties"):
        os.utime(f"{tmp_path}/root/one/properties/{name}", (old, old))
    newest = snapshots.latest_snapshot(snapshots.discover_snapshots(spark, f"{tmp_path}/root"))
    assert newest.first()["path"].endswith("/root/two")


def test_rebuild_plan(frame):
    key = "repo string, head_sha string"
    asked = frame(key, [("o/n", "abcdef1"), ("o/n", "abcdef2")])
    have = frame(key, [("o/n", "abcdef1"), ("x/y", "abcdef2")])
    assert rows(snapshots.plan_rebuild(asked, have), "head_sha") == [("abcdef2",)]
    assert rows(snapshots.snapshot_hits(asked, have), "head_sha") == [("abcdef1",)]
    keys = frame(key, [("o/n", "abcdef1"), ("o/n", "abc"), ("o/..", "abcdef1"), (None, "abcdef1")])
    assert rows(snapshots.accepted_keys(keys), "path") == [("o/n/abcdef1",)]
    assert snapshots.rejected_keys(keys).count() == 3


def test_adoption_of_a_corpus(frame):
    kind = "repo string, path string"
    got = snapshots.adopt_corpus(
        frame("repo string", [("a",), ("b",), ("c",)]), frame(kind, [("a", "corpus/a")]), frame(kind, [("a", "s/a"), ("b", "s/b")]),
    )
    assert rows(got) == [("a", "corpus/a", True), ("b", "s/b", False), ("c", None, False)]


class _Session:
    """The two things the folder choice looks at."""

    def __init__(self, folder, master):
        self.conf = self
        self.sparkContext = self
        self.folder, self.master = folder, master

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.folder or default


def test_shared_folder_follows_the_session():
    assert store.shared_folder(_Session("s3a://bucket/shared/", "yarn")) == "s3a://bucket/shared"
    assert os.path.isdir(store.shared_folder(_Session(None, "local[2]")))
    with pytest.raises(ValueError):
        store.shared_folder(_Session(None, "yarn"))


def test_a_graph_can_be_written_onto_itself(spark, make_graph, ask, tmp_path):
    one = make_graph(documents=[(1, "e.go", "go")], symbols=[(1, "p/T#")], chunks=[(1, 1, 0, 9)], mentions=[(1, 1, 8)], source="a")
    two = make_graph(documents=[(1, "f.go", "go")], symbols=[(1, "p/T#")], chunks=[(1, 1, 3, 9)], mentions=[(1, 1, 8)], source="b")
    folder = f"{tmp_path}/g"
    store.write_graph(one, folder)
    longer = merge.extend_graph(store.load_graph(spark, folder), "b", two)
    expected = rows(lookup.find_references(longer, ask("T")), "file")
    store.write_graph(longer, folder)
    assert rows(lookup.find_references(store.load_graph(spark, folder), ask("T")), "file") == expected and len(expected) == 2
    with pytest.raises(ValueError):
        merge.extend_graph(store.load_graph(spark, folder), "b", two)


def test_a_label_that_hides_a_source_is_refused(make_graph):
    parts = [make_graph(documents=[(1, "e.go", "go")], source=s) for s in ("", "x")]
    both = merge.CodeGraph(**{n: getattr(parts[0], n).unionByName(getattr(parts[1], n)) for n in ("documents", "symbols", "chunks", "mentions", "definition_ranges")})
    with pytest.raises(ValueError):
        merge.merge_graphs([("x", both), ("y", parts[0])])


def test_union_reads_odd_names(spark, make_graph, tmp_path):
    """Labels and sources with characters that folders and paths write in their own way."""
    labels = ["a/b c", "d+e%2F", "ü=1", ""]
    graphs = [make_graph(documents=[(1, "f.go", "go")], symbols=[(1, "p/T#")], chunks=[(1, 1, 0, 9)], mentions=[(1, 1, 8)], source=s)
              for s in ("", "x+y z%20", "q/r", "plain")]
    for i, graph in enumerate(graphs):
        store.write_graph(graph, f"{tmp_path}/g {i}", sites=False)
    both = store.union_sources(spark, [(label, f"{tmp_path}/g {i}") for i, label in enumerate(labels)])
    at_once = merge.merge_graphs(list(zip(labels, graphs)))
    for name in ("documents", "symbols", "mentions"):
        columns = sorted(set(getattr(at_once, name).columns) - {"relationships"})
        assert rows(getattr(both, name), *columns) == rows(getattr(at_once, name), *columns) != []
    plan = lambda n: both.documents._jdf.queryExecution().analyzed().toString().count("Relation")
    assert plan(4) == 1


def test_indexes_answer_as_scans_do(spark, make_graph, ask, frame, tmp_path):
    symbols = [(i, f"scip-go gomod m v{i % 3} `pkg/{'ab'[i % 2]}_x`/{name}#") for i, name in enumerate(
        ("Alpha", "alphabet", "Beta_x", "gamma%Gamma", "d", "Ünit", "ALPHA", "a.b", "x"))]
    graph = make_graph(documents=[(i, f"Src/{p}", "go") for i, p in enumerate(("a.go", "A/b.go", "b_c/d.go", "b%c/e.go", "ü/f.go"))],
                       symbols=symbols, chunks=[(i, i % 5, 0, 9) for i in range(9)], mentions=[(i, i, 8) for i in range(9)],
                       ranges=[(i, i % 5, i, 0, i + 3, 1) for i in range(9)], relations={i: [(symbols[i - 1][1], i % 2 == 0)] for i in range(1, 9)})
    store.write_graph(graph, f"{tmp_path}/g", site_buckets=3)
    stored = store.load_graph(spark, f"{tmp_path}/g")
    assert stored.indexes is not None and len(stored.indexes.path_splits) <= 3
    names = ask("alpha", "ALPHA", "a%t", "_x", "", "%", "d", "gamma%G", "no such name", "pkg/a_x", "ünit", "Ünit", "`/x", "zzzz%alpha", None)
    for match in ("like", "literal", "exact"):
        for query in (lookup.resolve_symbols, lookup.find_references, lookup.find_definitions, lookup.find_implementations):
            assert rows(query(stored, names, match=match)) == rows(query(graph, names, match=match))
    assert rows(lookup.find_implementations(stored, names, by_key=True)) == rows(lookup.find_implementations(graph, names, by_key=True)) != []
    assert rows(lookup.resolve_exact(stored, ["Alpha", "x"]), "symbol") == rows(lookup.resolve_exact(graph, ["Alpha", "x"]), "symbol") != []
    scopes = frame(schema.SCOPES, [(s, s) for s in ("src/", "SRC/A", "src/b_c", "src/b%c", "%/d", "src/ü", "", "zzz", "src/a/b.go", "a")])
    for boundary in (False, True):
        assert rows(files.list_symbols(stored, scopes, boundary=boundary)) == rows(files.list_symbols(graph, scopes, boundary=boundary)) != []


def test_index_lookups_read_some_partitions(spark, make_graph, ask, frame, tmp_path):
    graph = make_graph(documents=[(i, f"p{i:03}/f.go", "go") for i in range(60)], symbols=[(i, f"p/Name{i:03}#") for i in range(60)],
                       ranges=[(i, i, 1, 0, 2, 1) for i in range(60)], relations={i: [(f"p/Name{i - 1:03}#", True)] for i in range(1, 60)})
    store.write_graph(graph, f"{tmp_path}/g", site_buckets=8)
    stored = store.load_graph(spark, f"{tmp_path}/g")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    exact = lookup.resolve_exact(stored, ["Name007"])
    assert exact.count() == 1 and len(exact.inputFiles()) >= 1
    filtered = lambda df, column: re.search(rf"PartitionFilters: \[[^]]*{column}", plan(df))
    assert filtered(exact, "name_bucket") and "EqualTo(display_name,Name007)" in plan(exact)
    for df, table in ((lookup.resolve_symbols(stored, ask("Name007")), "gram_bucket"), (lookup.find_implementations(stored, ask("Name007")), "target_bucket"),
                      (files.list_symbols(stored, frame(schema.SCOPES, [("q", "p007/")])), "path_part")):
        assert filtered(df, table) and "dynamicpruning" in plan(df), table
    assert "Generate explode(grams" not in plan(lookup.resolve_symbols(stored, ask("Name007")))
