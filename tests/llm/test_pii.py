"""Personal data: the patterns against plain regular expressions, the field against all segmentations."""

import hashlib
import itertools
import math
import random
import re

import pytest

pytest.importorskip("symbolweave.llm")

from symbolweave.llm import pii_crf  # noqa: E402
from symbolweave.llm.pii_crf import KINDS, Field, Part  # noqa: E402

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            doubled = sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits)))
            fits = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else None,
                    "card": 13 <= len(digits) <= 19 and doubled % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]
            if fits:
                out.append((KINDS.index(kind), *m.span()))
    return sorted(out)


def checked(rng, n=16):
    digits = [rng.randrange(10) for _ in range(n - 1)]
    total = sum(sum(divmod(2 * d, 10)) if i % 2 == 0 else d for i, d in enumerate(reversed(digits)))
    return "".join(map(str, digits)) + str(-total % 10)


def test_patterns_equal_plain_expressions():
    rng = random.Random(1)
    for k in range(6000):
        text = "".join(rng.choice(("1", "23", "0", ".", "@", "a", "b-", "+", " ", "-", "(", ")", "٣", "é", "255", "x@y.z", checked(rng), "+1 (319) 555-5132")) for _ in range(rng.randrange(14)))
        assert sorted(pii_crf.base_spans(text)[0]) == plain(text), text
    for text in ("a" * 300_000, "1" * 300_000, "@" * 50_000, "+1" + " " * 100_000, "1." * 100_000, "a@" * 50_000):
        pii_crf.base_spans(text)


def test_field_equals_all_segmentations():
    rng = random.Random(2)
    for text in ("12 3", "a@b.c", "+1 2", "1.2-3"):
        part = Part(text, "x", "")
        names = {f for fs in part.features for f in fs}
        field = Field({f: [rng.uniform(-1, 1) for _ in KINDS] for f in sorted(names)}, [[rng.uniform(-1, 1) for _ in range(5)] for _ in range(5)])
        scores, values, cover = field.scores(part), {}, {}
        for k in range(part.length + 1):
            for picked in itertools.combinations(range(len(part.spans)), k):
                spans = sorted((part.spans[i], i) for i in picked)
                if any(a[0][1] > b[0][0] for a, b in zip(spans, spans[1:])):
                    continue
                for kinds in itertools.product(range(4), repeat=k):
                    named = dict(zip((i for _, i in spans), kinds))
                    path, t = [], 0
                    for (start, end), i in spans:
                        path += [4] * (start - t) + [named[i]]
                        t = end
                    path += [4] * (part.length - t)
                    values[tuple(named.items())] = sum(scores[i][y] for i, y in named.items()) + sum(field.steps[a][b] for a, b in zip([4, *path], path))
        total = math.log(sum(map(math.exp, values.values())))
        got, spans, _ = field.expected(part)
        assert got == pytest.approx(total)
        for named, value in values.items():
            for item in named:
                cover[item] = cover.get(item, 0) + math.exp(value - total)
        assert all(spans[i][y] == pytest.approx(cover.get((i, y), 0)) for i in range(len(part.spans)) for y in range(4))
        best = max(values, key=values.get)
        assert sorted((i, y) for y, i in field.best(part)) == sorted(best)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    phone = lambda: f"+{rng.randrange(1, 99)} ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    make = (lambda: f"{rng.choice('abcxyz')}{rng.randrange(9)}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com",
            lambda: ".".join(str(rng.randrange(256)) for _ in range(4)), lambda: checked(rng), phone)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for i in range(240):
        words = [word() for _ in range(20)]
        if i % 3:
            words[rng.randrange(20)] = make[i % 4]()
        else:
            words[rng.randrange(20)] = rng.choice((f"version {rng.randrange(9)}.{rng.randrange(9)}.", f"AKIA{rng.randrange(10**6)}XZ7", f"password={rng.getrandbits(64):x}", f"in {rng.randrange(1900, 2030)}", f"{rng.randrange(10**15, 10**16 - 1)}"))
        rows.append((i, " ".join(words)))
    return rows, [(1000, f"call {phone()} {checked(rng)} now"), (1001, f"tel ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}, thanks")]


def spans_of(spark, rows):
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id bigint, text string, spans string")
    return {r.doc_id: r for r in pii_crf.find_spans(df).collect()}


def test_field_adds_what_patterns_miss_and_leaves_clean_texts(spark, corpus):
    rows, hard = corpus
    got = spans_of(spark, rows + hard + [(2000, None), (2001, "")])
    for i, text in rows + hard:
        base = plain(text)
        assert got[i].base_sha256 == hashlib.sha256(pii_crf.written(base).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in KINDS] == [sum(s[0] == n for s in base) for n in range(4)]
        assert set(pii_crf.written(base).split(",")) <= set(got[i].spans.split(",")) | {""}
    assert all(got[i].spans == "" for i, text in rows if not plain(text))
    first, second = hard[0][1], hard[1][1]
    card = re.search(r"\d{16}", first).span()
    assert plain(first) == [] and got[1000].spans == f"card:{card[0]}:{card[1]},phone:5:{card[0] - 1}"
    assert got[1001].spans == f"phone:4:{second.index(',')}"
    assert got[2000].spans == got[2001].spans == "" and got[2000].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_repeated_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a@b.cd"), (None, "a@b.cd"), (3, "1.2.3.4")], "doc_id bigint, text string")
    assert sorted(r.spans for r in pii_crf.find_spans(df).collect()) == ["email:0:6", "email:0:6", "ip:0:7"]
    assert pii_crf.find_spans(df.limit(0)).count() == 0
