import pytest
from conftest import rows

from symbolweave import schema
from symbolweave.operators import files, lookup, reports

TS = "scip-typescript npm portal HEAD src/auth/`index.ts`/"
A, B, C = f"{TS}authorizeToParticipantAndAdminRole.", f"{TS}softAuthorizeToParticipantAndAdminRole.", f"{TS}userExists."


@pytest.fixture(scope="module")
def graph(make_graph):
    return make_graph(
        documents=[(1, "src/auth/index.ts", "ts"), (2, "src/api/a.ts", "ts"), (3, "src/api/b.ts", "ts"), (4, "src/api/c.ts", "ts")],
        symbols=[(10, A), (11, B), (12, C)],
        chunks=[(100, 1, 0, 50), (101, 2, 0, 100), (102, 2, 200, 250), (103, 3, 0, 80), (104, 4, 50, 120)],
        mentions=[(100, 10, 1), (101, 10, 8), (102, 10, 8), (103, 10, 8), (104, 10, 8), (100, 11, 1), (101, 11, 8), (103, 12, 8)],
        ranges=[(10, 1, 12, 0, 18, 1)],
    )


def test_definition_prefers_precise_range(graph, ask):
    found = lookup.find_definitions(graph, ask("authorizeToParticipantAndAdminRole"))
    assert rows(found, "display_name", "file", "start_line", "end_line", "start_char", "end_char") == [
        ("authorizeToParticipantAndAdminRole", "src/auth/index.ts", 12, 18, 0, 1),
        ("softAuthorizeToParticipantAndAdminRole", "src/auth/index.ts", 0, 50, None, None),
    ]


def test_definition_limit_keeps_exact_name(graph, ask):
    found = lookup.find_definitions(graph, ask("authorizeToParticipantAndAdminRole"), limit=1)
    assert rows(found, "symbol") == [(A,)]


@pytest.mark.parametrize("limit", [50, None])
def test_uncapped_definitions_equal_capped(graph, ask, limit):
    found = lookup.find_definitions(graph, ask("Role", "userExists"), limit=limit, cap=limit)
    assert rows(found, "query_id", "start_line", "start_char") == [("Role", 0, None), ("Role", 12, 0)]


def test_references_leave_definitions_out(graph, ask):
    asked = ask("authorizeToParticipantAndAdminRole")
    files_of = lambda df: {r[0] for r in rows(df.filter(f"symbol = '{A}'"), "file")}
    assert files_of(lookup.find_references(graph, asked)) == {"src/api/a.ts", "src/api/b.ts", "src/api/c.ts"}
    assert "src/auth/index.ts" in files_of(lookup.find_references(graph, asked, include_definition=True))


def test_reference_limit_and_cap_flag(graph, ask):
    found = lookup.find_references(graph, ask("authorizeToParticipantAndAdminRole"), limit=2)
    assert rows(found, "file", "start_line") == [("src/api/a.ts", 0), ("src/api/a.ts", 200)]
    assert {r[0] for r in rows(lookup.with_cap_flag(found, 2), "capped")} == {True}
    assert {r[0] for r in rows(lookup.with_cap_flag(found, 3), "capped")} == {False}


def test_resolution_ranks_exact_names_first(graph, ask):
    found = lookup.resolve_symbols(graph, ask("authorizeToParticipantAndAdminRole", "USEREXISTS", "nothing"), cap=50)
    assert rows(found, "query_id", "rank", "symbol", "is_exact") == [
        ("USEREXISTS", 1, C, False),
        ("authorizeToParticipantAndAdminRole", 1, A, True), ("authorizeToParticipantAndAdminRole", 2, B, False),
    ]


def test_resolution_cap_precedes_exact_names(make_graph, ask):
    many = [(i, f"x/{chr(97 + i)}b#") for i in range(4)] + [(9, "longer/path/b#")]
    graph = make_graph(symbols=many)
    assert rows(lookup.resolve_symbols(graph, ask("b"), cap=3), "is_exact") == [(False,)] * 3
    assert (True,) in rows(lookup.resolve_symbols(graph, ask("b"), cap=3, exact_first=True), "is_exact")


def test_wildcards_and_literal_matching(make_graph, ask):
    graph = make_graph(symbols=[(1, "p/get_user#"), (2, "p/getXuser#"), (3, "p/100%#"), (4, "p/a\\b#")])
    hits = lambda name, **kw: {r[0] for r in rows(lookup.resolve_symbols(graph, ask(name), **kw), "symbol")}
    assert hits("get_user") == {"p/get_user#", "p/getXuser#"}
    assert hits("get_user", match="literal") == {"p/get_user#"}
    assert hits("0%#") == {"p/100%#"} and hits("a\\b") == {"p/a\\b#"}
    assert len(hits("")) == 4 and len(hits("%")) == 4 and hits("%", match="literal") == {"p/100%#"}
    assert hits("_____________________") == set()
    with pytest.raises(ValueError):
        hits("x", match="regex")


def test_reference_roles(make_graph, ask):
    graph = make_graph(
        documents=[(1, "f.go", "go")], symbols=[(1, "pkg/Foo#")],
        chunks=[(i, 1, 10 * i, 10 * i + 5) for i in range(1, 7)],
        mentions=[(1, 1, 1), (2, 1, 2), (3, 1, 4), (4, 1, 8), (5, 1, 0), (6, 1, 17)],
    )
    starts = lambda **kw: [r[0] for r in rows(lookup.find_references(graph, ask("Foo"), **kw), "start_line")]
    assert starts() == [20, 30, 40]
    assert starts(include_definition=True) == [10, 20, 30, 40, 60]
    assert starts(role_policy="scip") == [20, 30, 40, 50]
    defs = lambda **kw: [r[0] for r in rows(lookup.find_definitions(graph, ask("Foo"), **kw), "start_line")]
    assert defs() == [10] and defs(bitwise=True) == [10, 60]


@pytest.fixture(scope="module")
def hierarchy(make_graph):
    base, old = "scip-go gomod m v1 `m/p`/Base#", "scip-go gomod n v9 `m/p`/Base#"
    return make_graph(
        documents=[(1, "a.go", "go"), (2, "b.go", "go")],
        symbols=[(1, base), (2, "scip-go gomod m v1 `m/p`/One#"), (3, "scip-go gomod m v1 `m/p`/Two#"),
                 (4, "scip-go gomod m v1 `m/p`/Three#"), (5, "scip-go gomod m v1 `m/p`/Four#")],
        relations={2: [("", True), (base, False), (base, True), (base, True)], 3: [(base, False)], 4: [(base, True)], 5: [(old, True)]},
        chunks=[(9, 2, 40, 49)], mentions=[(9, 4, 1)],
        ranges=[(2, 2, 30, 0, 31, 1), (2, 1, 5, 2, 9, 1), (3, 1, 1, 0, 2, 1), (5, 2, 7, 0, 8, 1)],
    )


def test_implementations(hierarchy, ask):
    found = lookup.find_implementations(hierarchy, ask("Base", ""))
    assert rows(found, "query_id", "display_name", "file", "start_line") == [("Base", "One", "a.go", 5)]
    keyed = lookup.find_implementations(hierarchy, ask("Base"), by_key=True)
    assert rows(keyed, "display_name") == [("Four",), ("One",)]
    spare = lookup.find_implementations(hierarchy, ask("Base"), fallback=True)
    assert rows(spare, "display_name", "start_line", "start_char") == [("One", 5, 2), ("Three", 40, None)]
    assert rows(lookup.find_implementations(hierarchy, ask("Base"), fallback=True, limit=1), "display_name") == [("One",)]


def test_list_symbols(graph, frame):
    scopes = frame(schema.SCOPES, [(s, s) for s in ("src/auth", "SRC/", "", "nowhere", "src/au", "src/%/index")])
    found = files.list_symbols(graph, scopes)
    assert {r[0] for r in rows(found, "query_id")} == {"src/auth", "SRC/", "src/au", "src/%/index"}
    assert {r[0] for r in rows(found, "symbol")} == {A}
    strict = files.list_symbols(graph, scopes, boundary=True)
    assert {r[0] for r in rows(strict, "query_id")} == {"src/auth", "SRC/"}
    assert rows(reports.symbols_by_file(found.filter("query_id = 'src/auth'"), 5), "symbols") == [
        (["authorizeToParticipantAndAdminRole (line 12)"],)]


def test_imports(graph, frame):
    asked = frame(schema.FILES, [(f, f) for f in ("src/api/b.ts", "src/auth/index.ts", "none.ts")])
    found = files.get_imports(graph, asked)
    assert rows(found, "query_id", "symbol") == [("src/api/b.ts", A), ("src/api/b.ts", C)]
    assert rows(reports.distinct_names(found), "display_name") == [("authorizeToParticipantAndAdminRole",), ("userExists",)]
    assert rows(reports.distinct_names(found, 1), "names") == [(["authorizeToParticipantAndAdminRole"],)]
    assert rows(reports.distinct_names(found, 9), "names") == [(["authorizeToParticipantAndAdminRole", "userExists"],)]
    assert rows(files.get_imports(graph, asked, limit=1), "symbol") == [(A,)]


def test_symbols_at(graph, frame):
    asked = frame(schema.POSITIONS, [("p", "src/api/a.ts", 50), ("edge", "src/api/a.ts", 250), ("past", "src/api/a.ts", 9999)])
    assert rows(files.symbols_at(graph, asked), "query_id", "symbol") == [("edge", A), ("p", A), ("p", B)]


def test_unmatched_and_grouped(graph, ask):
    asked = ask("userExists", "nothing")
    found = lookup.find_references(graph, asked)
    assert rows(lookup.unmatched(asked, found), "query_id") == [("nothing",)]
    assert rows(reports.references_by_name(found), "display_name", "location") == [("userExists", "src/api/b.ts:0-80")]
    assert rows(reports.references_by_name(found, 3), "display_name", "n_occurrences", "locations") == [
        ("userExists", 1, ["src/api/b.ts:0-80"])]
    assert rows(lookup.render(found), "location") == [("src/api/b.ts:0-80",)]
