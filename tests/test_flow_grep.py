import pytest
from conftest import rows

from symbolweave import schema
from symbolweave.functions.events import Recognizers
from symbolweave.operators import eventflow, grep, lookup, merge


@pytest.fixture(scope="module")
def flow_graph(make_graph):
    order, publish, unmarshal = ("scip-go gomod lib v1 `lib/e`/Order#", "scip-go gomod n v1 `nats`/Conn#Publish().",
                                 "scip-go gomod p v1 `proto`/Unmarshal().")
    producer = make_graph(
        documents=[(1, "svc/send.go", "go"), (2, "e/order.pb.go", "go")], symbols=[(1, order), (2, publish)],
        chunks=[(1, 1, 10, 20), (2, 2, 0, 9)], mentions=[(1, 1, 8), (1, 2, 8), (2, 1, 1)], source="pub",
    )
    consumer = make_graph(
        documents=[(1, "svc/read.go", "go"), (2, "svc/other.go", "go")], symbols=[(1, order), (2, unmarshal)],
        chunks=[(1, 1, 30, 40), (2, 2, 0, 9)], mentions=[(1, 1, 8), (1, 2, 8), (2, 1, 8)], source="sub",
    )
    return merge.merge_graphs([("pub", producer), ("sub", consumer)])


def test_event_flow_over_two_sources(flow_graph, ask):
    sites = eventflow.event_flow_sites(flow_graph, ask("Order", "none"))
    assert rows(sites, "repo", "flow_role", "location") == [
        ("pub", "definition", "pub/e/order.pb.go:0-9"), ("pub", "producer", "pub/svc/send.go:10-20"),
        ("sub", "consumer", "sub/svc/read.go:30-40"), ("sub", "unknown", "sub/svc/other.go:0-9"),
    ]
    assert rows(eventflow.event_flow_summary(sites)) == [("Order", ["pub"], ["sub"], "pub → sub")]
    grouped = eventflow.event_flow_by_repo(sites)
    assert rows(grouped, "role_group", "repo", "n_sites") == [
        ("consumer", "sub", 1), ("other", "pub", 1), ("other", "sub", 1), ("producer", "pub", 1)]


def test_flow_needs_both_sides(flow_graph, ask):
    sites = eventflow.event_flow_sites(flow_graph, ask("Order"), Recognizers(produce=("nothing",)))
    assert rows(eventflow.event_flow_summary(sites)) == [("Order", [], ["sub"], None)]


@pytest.fixture(scope="module")
def grep_graph(make_graph):
    return make_graph(
        documents=[(1, "pkg/auth/check.go", "go"), (2, "pkg/api/handler.go", "go"), (3, "../evil.go", "go"), (4, "gone.go", "go")],
        symbols=[(1, "pkg/auth/Check().")],
        chunks=[(2, 2, 10, 10), (3, 3, 1, 1), (4, 4, 2, 2), (5, 2, 90, 95)],
        mentions=[(2, 1, 8), (3, 1, 8), (4, 1, 8), (5, 1, 8)], ranges=[(1, 1, 4, 0, 8, 1)],
    )


@pytest.fixture(scope="module")
def lines(frame):
    texts = [("", path, "".join(f"{path[-2:]} line {i}\n" for i in range(n)))
             for path, n in (("pkg/auth/check.go", 10), ("pkg/api/handler.go", 12), ("../evil.go", 5))]
    return grep.source_lines(frame("source string, file string, text string", texts))


def test_definition_body_lines(grep_graph, lines, ask):
    shown = grep.grep_symbols(grep_graph, ask("Check"), lines, context=2)
    assert rows(shown.filter("part = 'definition'"), "line_no", "numbered") == [
        (i, f"  {i + 1:>5} go line {i}") for i in range(4, 9)]


@pytest.mark.parametrize("context,first", [(2, 8), (9999, 0), (-5, 10)])
def test_reference_window(grep_graph, lines, ask, context, first):
    shown = grep.grep_symbols(grep_graph, ask("Check"), lines, context=context)
    window = shown.filter("part = 'reference' and file = 'pkg/api/handler.go' and start_line = 10")
    last = 11 if context > 0 else 10
    assert sorted(r[0] for r in window.select("line_no").collect()) == list(range(first, last + 1))


def test_windows_without_text(grep_graph, lines, ask):
    shown = grep.grep_symbols(grep_graph, ask("Check"), lines, context=2).filter("line_no is null")
    assert rows(shown, "file", "source_available", "line") == [
        ("../evil.go", False, None), ("gone.go", False, None), ("pkg/api/handler.go", True, None)]


def test_long_bodies_are_cut_and_marked(frame, make_graph, ask):
    graph = make_graph(documents=[(1, "f", "go")], symbols=[(1, "p/Big#")], ranges=[(1, 1, 10, 0, 299, 1)])
    text = "\n".join(str(i) for i in range(400))
    lines = grep.source_lines(frame("source string, file string, text string", [("", "f", text)]))
    whole = grep.grep_symbols(graph, ask("Big"), lines)
    assert sorted(r["line_no"] for r in whole.collect()) == list(range(10, 300))
    shown = grep.grep_symbols(graph, ask("Big"), lines, body_lines=120)
    got = sorted(r["line_no"] for r in shown.collect())
    assert got == list(range(10, 130))
    assert {(r["truncated"], r["end_line"]) for r in shown.collect()} == {(True, 299)}


def test_site_counts(grep_graph, ask):
    found = lookup.find_references(grep_graph, ask("Check"), limit=15)
    assert rows(grep.reference_site_counts(found), "n_sites") == [(4,)]
    assert schema.SOURCE_LINES.fieldNames() == ["source", "file", "line_no", "line"]


def test_an_empty_file_is_available_without_lines(spark):
    texts = spark.createDataFrame([("s", "a.go", ""), ("s", "b.go", None)], "source string, file string, text string")
    windows = spark.createDataFrame([("s", "a.go", 0, 3), ("s", "b.go", 0, 3)], "source string, file string, first_line int, last_line int")
    shown = grep.window_lines(windows, grep.source_lines(texts))
    assert sorted((r.file, r.source_available, r.line) for r in shown.collect()) == [("a.go", True, None), ("b.go", False, None)]
