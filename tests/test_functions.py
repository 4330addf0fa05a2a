import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from symbolweave.functions import events, monikers, paths, ranges, roles, text
from symbolweave.sources.snapshots import valid_snapshot_key


def one(spark, *columns):
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return list(row)


def test_display_name(spark):
    cases = {
        "scip-typescript npm portal HEAD src/`auth.ts`/softAuthorize().": "softAuthorize",
        "scip-go gomod m v1 `m/pkg`/Order#": "Order",
        "a/T#M().": "T#M",
        "src/`index.ts`/": "index.ts",
        "local 4": "local 4",
        "": "",
    }
    assert one(spark, *[monikers.display_name(F.lit(s)) for s in cases]) == list(cases.values())


def test_dedup_key_and_storable_symbol(spark):
    package, local, short = "scip-go gomod m v1 `m/p`/T# x", "local 0", "scip-go gomod m v1"
    keys = one(spark, *[monikers.dedup_key(F.lit(s), F.lit("a")) for s in (package, local, short, "", None)])
    assert keys == ["scip-go gomod * * `m/p`/T# x", "a\0local 0", f"a\0{short}", "", None]
    stored = one(spark, *[monikers.storable_symbol(F.lit(s), F.lit("a")) for s in (package, local, "", None)])
    assert stored == [package, "a/local 0", "", None]
    other = one(spark, monikers.dedup_key(F.lit("scip-k8s . . . default/Secret/x#"), F.lit("a")))
    assert other == ["a\0scip-k8s . . . default/Secret/x#"]


def test_moniker_parts_and_package_test(spark):
    parts = one(spark, monikers.moniker_parts(F.lit("s gomod p v d e")))[0]
    assert tuple(parts) == ("s", "gomod", "p", "v", "d e")
    assert one(spark, monikers.is_package_symbol(F.lit("s gomod p v d")), monikers.is_package_symbol(F.lit("s x p v d")),
               monikers.is_package_symbol(F.lit("s gomod p v"))) == [True, False, False]


def test_descriptors(spark):
    names = [('resource "aws_s3_bucket" "logs"', 23), ('module "vpc"', 5), ('variable "region"', 13), ("x", 99), ('""  ', 23)]
    got = one(spark, *[monikers.terraform_descriptor(F.lit(n), F.lit(k)) for n, k in names])
    assert got == ["resource/aws_s3_bucket/logs#", "module/vpc#", "variable/region.", "x/", "unknown/"]
    assert one(spark, monikers.proto_ref_descriptor(F.lit(".assets.v1.Money"))) == ["assets/v1/Money#"]
    assert one(spark, monikers.k8s_symbol(F.lit(""), F.lit("Secret"), F.lit("s"))) == ["scip-k8s . . . default/Secret/s#"]
    assert one(spark, monikers.proto_symbol(F.lit("method"), F.lit("a/Svc"), F.lit("Get")),
               monikers.proto_symbol(F.lit("message"), F.lit(""), F.lit("M"))) == [
        "scip-proto proto . . a/Svc#Get().", "scip-proto proto . . M#"]


def _array(values):
    return F.lit(None).cast("array<int>") if values is None else F.array(*[F.lit(v) for v in values]).cast("array<int>")


def test_span_to_range(spark):
    spans = [[1, 2, 3], [1, 2, 1, 5], [1, 2, 3, 5], None, []]
    got = [None if r is None else tuple(r) for r in one(spark, *[ranges.span_to_range(_array(s)) for s in spans])]
    assert got == [(1, 2, 3), (1, 2, 5), None, None, None]


def test_invalid_enclosing_range(spark):
    shapes = [[87, 0, 0, 0], [10, 0, 20, 1], [10, 0, 5], [10, 20, 5], [], None]
    assert one(spark, *[ranges.invalid_enclosing_range(_array(s)) for s in shapes]) == [True, False, False, True, False, False]


def test_render_location(spark):
    def loc(a, b, c):
        return ranges.render_location(F.lit("f"), F.lit(a), F.lit(b), F.lit(c).cast("int"))
    assert one(spark, loc(12, 18, 0), loc(42, 42, None), loc(10, 50, None)) == ["f:12:0", "f:42", "f:10-50"]


def test_windows(spark):
    assert one(spark, *[ranges.clamp_context(F.lit(c)) for c in (-3, 4, 9999)]) == [0, 4, 10]
    assert tuple(one(spark, ranges.clamp_window(F.lit(-2), F.lit(99), F.lit(10)))[0]) == (0, 9)
    assert tuple(one(spark, ranges.body_span(F.lit(5), F.lit(124)))[0]) == (5, 124, False)
    assert tuple(one(spark, ranges.body_span(F.lit(5), F.lit(125)))[0]) == (5, 124, True)


def test_lsp_range_and_symbol_range(spark):
    lit = F.lit
    assert one(spark, ranges.lsp_range(lit(1), lit(2), lit(1), lit(9)), ranges.lsp_range(lit(1), lit(2), lit(3), lit(9))) == [9, 3]
    null = lit(None).cast("string")
    assert one(spark, ranges.symbol_range(null, lit("s"), lit("r")), ranges.symbol_range(lit("l"), lit("s"), lit("r"))) == ["s", "l"]


def test_paths(spark):
    assert one(spark, *[paths.repo_of(F.lit(p)) for p in ("a/b/c", "x")]) == ["a", "<root>"]
    assert one(spark, paths.prefix_path(F.lit(""), F.lit("p")), paths.prefix_path(F.lit("r"), F.lit("p"))) == ["p", "r/p"]
    assert one(spark, *[paths.path_inside_workspace(F.lit(p)) for p in (
        "a/b", "../x", "a/../../x", "a/../b", "/etc/passwd", "./.",
    )]) == [True, False, False, True, False, True]
    assert one(spark, *[paths.relative_to_root(F.lit(p), "/w/s") for p in (
        "/w/s/a.tf", "/w/s/../s/b/./c.tf", "/w/sx/d.tf", "/w/s",
    )]) == ["a.tf", "b/c.tf", "d.tf", "."]
    assert one(spark, *[paths.uri_to_path(F.lit(u)) for u in (
        "file:///a%20b/c+d.tf", "https://x/y", "file://host/p?q#f", "file:///bad%zz",
    )]) == ["/a b/c+d.tf", None, "/p", "/bad%zz"]
    assert one(spark, *[paths.rendered_path(F.lit(p)) for p in ("", ".", "a/b")]) == [
        "./__rendered__.yaml", "./__rendered__.yaml", "a/b/__rendered__.yaml"]
    assert one(spark, paths.snapshot_path(F.lit("o/n"), F.lit("abc1234"))) == ["o/n/abc1234"]


def test_roles(spark):
    values = [0, 1, 2, 8, 17]
    assert one(spark, *[roles.is_reference_role(F.lit(r)) for r in values]) == [False, False, True, True, False]
    assert one(spark, *[roles.is_reference_role(F.lit(r), "scip") for r in values]) == [True, False, True, True, False]
    assert one(spark, *[roles.is_definition_role(F.lit(r)) for r in values]) == [False, True, False, False, False]
    assert one(spark, *[roles.is_definition_role(F.lit(r), bitwise=True) for r in values])[-1] is True
    with pytest.raises(ValueError):
        roles.is_reference_role(F.lit(1), "other")


def test_like_follows_ascii_rules(spark):
    def like(symbol, name):
        return text.symbol_like(F.lit(symbol), F.lit(name))
    assert one(spark, like("aXbXc", "xBx"), like("a_c", "a_c"), like("abc", "a_c"), like(r"a\b", r"a\b"), like("É", "é"),
               like("50% off", "0%f")) == [True, True, True, True, False, True]


def test_path_prefix(spark):
    def prefix(path, scope, **kw):
        return text.path_prefix(F.lit(path), F.lit(scope), **kw)
    assert one(spark, prefix("src/authz/x", "src/auth"), prefix("src/authz/x", "src/auth", boundary=True),
               prefix("src/auth/x", "src/auth/", boundary=True), prefix("a", ""), prefix("a", "/")) == [
        True, False, True, False, True]


def test_split_lines(spark):
    cases = ["a\nb", "a\r\nb\rc\n", "", "\n", "a\n\nb", "x\x0by z\x85"]
    got = one(spark, *[text.split_lines(F.lit(c)) for c in cases])
    assert got == [c.splitlines() for c in cases]
    assert one(spark, text.numbered_line(F.lit(4), F.lit("x")), text.numbered_line(F.lit(None).cast("int"), F.lit("x"))) == [
        "      5 x", None]


def test_token_hits_respect_word_starts(spark):
    fixed = events.token_hits(F.lit("unmarshal eventpublish handler"), ("marshal", "unmarshal", "publish", "handle", "handler"))
    column = events.token_hits(F.lit(r"a.b c\ed"), F.array(F.lit("a.b"), F.lit("axb"), F.lit(r"c\ed"), F.lit(r"c\Ed")))
    assert one(spark, fixed, column) == [3, 2]


def test_classify_site(spark):
    cases = [
        ("api/internal/service/publisher.go", ["DepositEvent", "EventStreamer.Publish", "proto.Marshal"], "producer"),
        ("api/internal/service/handler.go", ["DepositEvent", "Unmarshal", "handleDeposit"], "consumer"),
        ("c/h.go", ["DepositEvent", "Unmarshal"], "consumer"),
        ("x/relay.go", ["DepositEvent", "Publish", "Unmarshal", "handle"], "consumer"),
        ("p/funding.pb.go", ["DepositEvent"], "definition"),
        ("s/subscriber/a.go", ["DepositEvent"], "consumer"),
        ("s/publisher/a.go", ["DepositEvent"], "producer"),
        ("s/worker/a.go", ["DepositEvent"], "unknown"),
    ]
    default = events.Recognizers()
    as_column = events.recognizers_from_json(F.lit(""))
    for rules in (default, as_column):
        got = one(spark, *[
            events.classify_site(F.lit(p), F.array(*[F.lit(n) for n in names]), rules) for p, names, _ in cases
        ])
        assert got == [role for _, _, role in cases]


@pytest.mark.parametrize("raw", [
    "", "{not valid json", "[1]", '{"consume": ["poll", "ConsumerRecord"]}', '{"consume": ["a", 1]}', '{"consume": []}',
    '{"produce": "x", "consume": null}', '{"definition_markers": [".GEN."]}', '{"consume": [null]}',
])
def test_recognizer_texts(spark, raw):
    expected = recognizers_of(raw)
    got = one(spark, events.recognizers_from_json(F.lit(raw)))[0]
    for key in ("produce", "consume", "produce_paths", "consume_paths", "definition_markers"):
        assert tuple(got[key]) == getattr(expected, key), key


def recognizers_of(raw):
    """What a configuration text means, by plain parsing."""
    try:
        given = json.loads(raw or "{}")
    except ValueError:
        given = {}
    usable = {k: tuple(t.lower() for t in v) for k, v in (given.items() if isinstance(given, dict) else ())
              if isinstance(v, list) and all(isinstance(t, str) for t in v)}
    return events.Recognizers(**usable)


def test_snapshot_keys(spark):
    sha = "abcdef1234"
    keys = [("o/n", sha), ("o/n", "../etc/passwd"), ("o/n", "abc/def1"), ("o/../n", sha), ("o/n", "abc")]
    got = one(spark, *[valid_snapshot_key(F.lit(r), F.lit(s)) for r, s in keys])
    assert got == [True, False, False, False, False]


def test_sql_functions_agree_with_columns(spark):
    from symbolweave.functions.sql import register_sql_functions
    register_sql_functions(spark)
    df = spark.createDataFrame([("scip-go gomod m v `p`/T#", "a"), ("local 1", "b"), ("", "c"), (None, "d")], "symbol string, label string")
    by_sql = rows(df.selectExpr("norm_moniker(symbol, label)", "storable_symbol(symbol, label)"))
    symbol, label = F.col("symbol"), F.col("label")
    assert by_sql == rows(df.select(monikers.dedup_key(symbol, label), monikers.storable_symbol(symbol, label)))
