import pytest
from conftest import rows
from pyspark.sql import functions as F

from symbolweave.operators import lookup, merge


def go(module, version, path, name="T"):
    return f"scip-go gomod {module} {version} `{path}`/{name}#"


def source(make_graph, label, symbol, role=8, path="src/x.py", ranges=(), language="go"):
    return make_graph(
        documents=[(1, path, language)], symbols=[(5, symbol)], chunks=[(7, 1, 0, 9)], mentions=[(7, 5, role)],
        ranges=ranges, source=label,
    )


def test_one_source_passes_through(make_graph):
    graph = source(make_graph, "a", "local 0")
    assert merge.merge_graphs([("label", graph)]) is graph
    with pytest.raises(ValueError):
        merge.merge_graphs([])


def test_same_path_and_languages_stay_apart(make_graph, ask):
    merged = merge.merge_graphs([
        ("repo-a", source(make_graph, "repo-a", go("a", "1", "a/p", "Alpha"))),
        ("repo-b", source(make_graph, "repo-b", go("b", "1", "b/p", "Beta"), language="python")),
    ])
    assert rows(merged.documents, "relative_path", "language") == [("repo-a/src/x.py", "go"), ("repo-b/src/x.py", "python")]
    found = lookup.find_references(merged, ask("Alpha", "Beta"))
    assert rows(found, "query_id", "file") == [("Alpha", "repo-a/src/x.py"), ("Beta", "repo-b/src/x.py")]


def test_one_descriptor_is_one_symbol(make_graph, ask):
    merged = merge.merge_graphs([
        ("lib", source(make_graph, "lib", go("lib", "v1", "lib/events", "Order"), role=1, ranges=[(5, 1, 2, 0, 4, 1)])),
        ("svc", source(make_graph, "svc", go("svc", "v9", "lib/events", "Order"))),
        ("own", source(make_graph, "own", go("own", "v1", "own/models", "Order"))),
    ])
    assert rows(merged.symbols, "symbol") == [(go("lib", "v1", "lib/events", "Order"),), (go("own", "v1", "own/models", "Order"),)]
    found = lookup.find_references(merged, ask("lib/events"))
    assert rows(found, "file") == [("svc/src/x.py",)]
    assert rows(lookup.find_definitions(merged, ask("lib/events")), "file", "start_line") == [("lib/src/x.py", 2)]


def test_local_symbols_never_unify(make_graph):
    merged = merge.merge_graphs([
        ("repo-a", source(make_graph, "repo-a", "local 0")), ("repo-b", source(make_graph, "repo-b", "local 0")),
    ])
    assert rows(merged.symbols, "symbol") == [("repo-a/local 0",), ("repo-b/local 0",)]
    assert merged.mentions.select("symbol_source", "symbol_id").distinct().count() == 2


def test_key_held_twice_by_one_source(make_graph):
    twice = make_graph(
        documents=[(1, "f", "go")], symbols=[(5, go("m", "v1", "p")), (6, go("m", "v2", "p"))], chunks=[(7, 1, 0, 9)],
        mentions=[(7, 5, 8), (7, 6, 8)], ranges=[(6, 1, 0, 0, 1, 1)], source="a",
    )
    merged = merge.merge_graphs([("a", twice), ("b", source(make_graph, "b", go("m", "v3", "p")))])
    assert rows(merged.symbols, "symbol_source", "symbol_id") == [("a", 5)]
    assert rows(merged.mentions, "source", "symbol_id") == [("a", 5), ("b", 5)]
    assert rows(merged.definition_ranges, "symbol_id") == [(5,)]


def test_first_source_describes_the_symbol(make_graph):
    first, second = source(make_graph, "z", go("m", "v1", "p")), source(make_graph, "a", go("m", "v2", "p"))
    named = lambda g, n: g.with_tables(symbols=g.symbols.withColumn("documentation", F.lit(n)))
    merged = merge.merge_graphs([("z", named(first, "one")), ("a", named(second, "two"))])
    assert rows(merged.symbols, "symbol_source", "documentation") == [("z", "one")]


def test_extra_symbol_columns_survive(make_graph):
    extra = source(make_graph, "a", go("m", "v1", "p"))
    extra = extra.with_tables(symbols=extra.symbols.withColumn("signature", F.lit("func()")))
    merged = merge.merge_graphs([("a", extra), ("b", source(make_graph, "b", go("m", "v1", "q")))])
    assert rows(merged.symbols, "symbol_source", "signature") == [("a", "func()"), ("b", None)]


def test_null_monikers_are_left_out_and_counted(make_graph):
    broken = make_graph(symbols=[(1, None), (2, "local 1")], source="a")
    marked = broken.symbols.withColumns({"_label": F.lit("a"), "_position": F.lit(0)})
    assert rows(merge.keyed_symbols(marked), "symbol_id") == [(2,)]
    assert rows(merge.null_moniker_count(broken.symbols)) == [("a", 1)]
    assert merge.merge_sources(broken).symbols.count() == 1


def _three(make_graph):
    return [
        (name, make_graph(
            documents=[(1, "f.go", "go")], symbols=[(1, go(name, "v1", "shared")), (2, go(name, "v1", name)), (3, "local 3")],
            chunks=[(1, 1, 0, 9)], mentions=[(1, 1, 8), (1, 2, 1), (1, 3, 8)], ranges=[(2, 1, 0, 0, 1, 1)], source=name,
        )) for name in ("a", "b", "c")
    ]


def _everything(graph):
    return {name: rows(table, *sorted(set(table.columns) - {"relationships"})) for name, table in graph.tables().items()}


def test_merge_is_repeatable(make_graph):
    assert _everything(merge.merge_graphs(_three(make_graph))) == _everything(merge.merge_graphs(_three(make_graph)))


def test_merge_of_merged_graph(make_graph):
    a, b, c = _three(make_graph)
    flat = merge.merge_graphs([a, b, c])
    nested = merge.merge_graphs([("", merge.merge_graphs([a, b])), c])
    package = "symbol LIKE 'scip%'"
    assert rows(flat.symbols.filter(package), "symbol") == rows(nested.symbols.filter(package), "symbol")
    assert rows(flat.documents, "relative_path") == rows(nested.documents, "relative_path")
    assert flat.mentions.count() == nested.mentions.count()


def test_every_edge_meets_one_symbol(make_graph):
    merged = merge.merge_graphs(_three(make_graph))
    for edges in (merged.mentions, merged.definition_ranges):
        assert edges.join(merged.symbols, ["symbol_source", "symbol_id"]).count() == edges.count()


def test_incremental_merge_equals_full_merge(make_graph):
    a, b, c = _three(make_graph)
    grown = merge.extend_graph(merge.merge_graphs([a, b]), *c)
    full = merge.merge_graphs([a, b, c])
    assert _everything(grown) == _everything(full)


def test_corpus_union(make_graph):
    session = source(make_graph, "", go("m", "v1", "p"), path="own.py")
    corpus = source(make_graph, "", go("m", "v2", "p"), path="other.go")
    merged = merge.union_with_corpus(session, corpus)
    assert rows(merged.documents, "relative_path") == [("corpus/other.go",), ("own.py",)]
    assert rows(merged.symbols, "symbol") == [(go("m", "v1", "p"),)]
    assert merge.union_with_corpus(session, None) is session


def test_id_offsets(spark, frame):
    documents = frame("source string, doc_id long", [("a", 3), ("a", 9), ("b", 4)])
    chunks = frame("source string, chunk_id long", [("b", 20), ("c", 1)])
    positions = frame("source string, position int", [("a", 0), ("b", 1), ("c", 2)])
    assert rows(merge.id_offsets(documents, chunks, positions), "source", "doc_offset", "chunk_offset") == [
        ("a", 0, 0), ("b", 9, 0), ("c", 13, 20)]
