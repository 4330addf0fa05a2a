"""Language parses, toxicity counts and suffix groups against plain computations."""

import random

import numpy as np
import pytest

pytest.importorskip("symbolweave.llm")

from pyspark.sql import functions as F  # noqa: E402

from symbolweave.llm import langid, suffix_dedup, toxicity  # noqa: E402


def plain_phrases(text, learnt):
    i = n = 0
    while i < len(text):
        j = i
        while j < len(text) and text[i : j + 1] in learnt:
            j += 1
        i, n = max(j, i + 1), n + 1
    return n


@pytest.mark.parametrize("block", [4, 9, 256])
def test_phrases_equal_longest_matches(monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK", block)
    rng = random.Random(block)
    say = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    learnt = {"aa": say("ab ", 90), "bb": say("abcd", 300), "cc": say("xyz ", 40), "dd": "abababababab" * 9}
    parser = langid.Parser(learnt)
    texts = [say(rng.choice(("ab", "abcd ", "abxyzq", "q", "é ab")), rng.randrange(1, 900)) for _ in range(60)] + [learnt["bb"], learnt["dd"] * 8]
    got = parser.phrases([np.array([ord(c) for c in t], dtype=np.uint32) for t in texts])
    assert got.tolist() == [[plain_phrases(t, learnt[n]) for n in sorted(learnt)] for t in texts]


def test_marks_alone_are_no_language(spark):
    docs = spark.createDataFrame([(i, "kalo timu reno", "aa") for i in range(9)] + [(20, "́̂", None), (21, "́ é", None)], "doc_id bigint, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in langid.identify(docs, langid.fit(docs)).collect()}
    assert found[20] == "und" and found[21] == "aa"
    assert langid.identify(docs.limit(0), langid.fit(docs)).count() == 0


def test_labels_of_any_kind(spark):
    docs = spark.createDataFrame([(i, f"text {i} {'vile' if i % 2 else 'kind'}") for i in range(40)] + [(1, "other vile row")] * 3, "doc_id bigint, text string")
    rows = [(i, i % 2) for i in range(40)] + [(1, 0), (3, 1), (5, None), (7, 2), (50, 2), (None, 1)]
    labels = spark.createDataFrame(rows, "doc_id bigint, toxic int")
    for _ in range(2):
        sample = toxicity.labelled_sample(docs, labels.repartition(3), F.lit(True), "toxic")
        assert sorted(r.y for r in sample.collect()) == [0] * 20 + [1] * 20
    assert toxicity.labelled_sample(docs, labels, F.lit(True), "toxic", rows=5).count() == 5


def test_features_equal_plain_counts(spark):
    rng = random.Random(3)
    rows = [(" ".join(rng.choice(("kind", "good", "fine", "calm")) for _ in range(6)) + (" vile" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(90)]
    model = toxicity.fit(spark.createDataFrame(rows, "text string, y int"))
    held = [set(toxicity.gram_buckets(t).tolist()) for t, _ in rows]
    sizes = [sum(y == k for _, y in rows) for k in (0, 1)]
    counts = {b: [sum(b in h for h, (_, y) in zip(held, rows) if y == k) for k in (0, 1)] for b in set().union(*held)}
    wanted = {b for b, (a, c) in counts.items() if a + c >= toxicity.LEAST_COUNT}
    assert set(np.flatnonzero(model.slot).tolist()) == wanted
    vile = set(toxicity.gram_buckets("vile").tolist()) & wanted
    ratio = {b: np.log((c + 1) / (sizes[1] + 2)) - np.log((a + 1) / (sizes[0] + 2)) for b, (a, c) in counts.items()}
    assert all(ratio[b] > 0 for b in vile) and all((model.score(t) > 0.5) == bool(y) for t, y in rows)


def test_suffix_arrays_of_many_kinds():
    rng = random.Random(4)
    for text in ([0] * 300, list(range(200)), list(range(200, 0, -1)), [0, 1] * 150, [rng.randrange(255) for _ in range(2000)], [], [3]):
        assert suffix_dedup.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_alike_contexts_hold_every_shared_window():
    rng = random.Random(5)
    length, gram = 60, 10
    say = lambda n: bytes(rng.choice(b"ab") if rng.random() < 0.1 else 97 for _ in range(n))
    middle = b"0123456789"
    contexts = [(i, 1, skip, say(skip) + middle + say(rng.randrange(51))) for i in range(80) for skip in [rng.randrange(51)]]
    kept = suffix_dedup._alike(contexts, length, gram)
    windows = [{data[k : k + length] for k in range(max(0, skip + gram - length), skip + 1) if k + length <= len(data)} for _, _, skip, data in contexts]
    shared = [set().union(*(a & b for j, b in enumerate(windows) if i != j)) for i, a in enumerate(windows)]
    assert any(shared) and None in kept
    for (_, _, _, data), part, found in zip(contexts, kept, shared):
        assert not found or all(w in data[part[0] : part[1]] for w in found)


def test_one_gram_in_most_contexts(spark):
    """A hot gram, decided in arrays and counted by hash, gives the bytes that plain counting gives."""
    rng = random.Random(6)
    say = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    hot, tail = "z" * 40, say(190)
    rows = [(i, say(120) + hot + (tail if i % 3 else say(190))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    counts = {}
    for _, t in rows:
        for k in range(len(t) - 199):
            counts[t[k : k + 200]] = counts.get(t[k : k + 200], 0) + 1
    want = {}
    for i, t in rows:
        gone = [False] * len(t)
        for k in range(len(t) - 199):
            if counts[t[k : k + 200]] > 1:
                gone[k : k + 200] = [True] * 200
        want[i] = "".join(c for c, g in zip(t, gone) if not g)
    for limit in (4096, 10):
        assert {r.doc_id: bytes(r.kept).decode() for r in suffix_dedup.dedup_bytes(docs, hot=limit).collect()} == want
