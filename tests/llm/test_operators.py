"""Operators on small frames: nulls, empty and long texts, repeated rows, extra columns, and brute-force results."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from symbolweave.llm import bpe, common, components, fuzzy_lines, itq, jaccard_join, langid, mixing, norm_topk, suffix_dedup, toxicity, warc

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, size int, component string"
WORDS = [f"w{i}" for i in range(60)]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 0, "x", 1, "y") for i, t, lang, s in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    base = say(120)
    rows = [(1, base, "en", "a"), (2, base, "en", "a"), (3, base + " tail", "en", None), (4, None, None, None), (5, "", "de", "b"),
            (6, " \n ", "de", "b"), (7, say(4000), "en", "a"), (8, "w1", "de", "c"), (9, "w1", "de", "c"), (None, base, "en", "a"),
            (10, say(100), "en", "a"), (10, say(100), "en", "a"), (11, "ü" * 300, "de", "b")]
    return documents(spark, rows)


def test_components_take_the_smallest_node(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (7, 7), (3, 5), (None, 1), (5, 4)], "a bigint, b bigint")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {3: 3, 4: 3, 5: 3, 8: 8, 9: 8, 7: 7}
    assert components.components(edges.limit(0)).count() == 0


def test_mix_meets_its_targets(spark, odd):
    rows = mixing.mix(odd).collect()
    assert len(rows) == 13 and all(r.taken <= 2 * r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.source, [r.target, 0])[1] += r.taken
    assert all(abs(target - taken) <= 1 for target, taken in by.values())
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(odd).collect()))
    assert mixing.mix(odd.limit(0)).count() == 0
    assert mixing.mixed_documents(odd).columns == odd.columns


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((20, 16))
    rows = [(i * 3 + k, (base[i] + 0.05 * k * rng.standard_normal(16)).tolist(), i % 2, 1) for i in range(20) for k in range(3)]
    rows += [(100, rows[0][1], 0, 1), (101, None, 0, 1), (102, [0.0] * 16, 0, 1), (103, [float("nan")] * 16, 0, 1), (104, rows[0][1], None, 1), (105, [1.0, None], 1, 1), (106, [1.0], 1, 1)]
    got = {r.vec_id: r for r in itq.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, rep int"), block=8).collect()}
    good = [(i, np.array(v) / np.linalg.norm(v), label) for i, v, label, _ in rows if i < 101]
    for i, v, label in good:
        assert got[i].n_links == sum(j != i and m == label and v @ w >= 0.93 for j, w, m in good)
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in (101, 102, 103, 104, 105, 106))
    assert got[100].component_id == 0 and not got[100].kept


def test_top_products_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(8) * rng.exponential()).tolist()) for i in range(300)] + [(300, None), (301, [float("inf")] * 8), (302, [0.0] * 8), (303, [1e300] * 8)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {}
    for r in norm_topk.top_k(frame.where("vec_id < 303"), frame.where("vec_id % 50 = 0").select("vec_id"), block=64).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    whole = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows if v is not None and np.isfinite(v).all() and i < 303}
    for q in (0, 50, 250):
        best = sorted(((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q))[:10]
        assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert 300 not in got


def test_suffix_arrays_and_removed_bytes(spark, odd):
    rng = random.Random(3)
    for _ in range(200):
        text = [rng.randrange(rng.choice((1, 2, 4))) for _ in range(rng.randrange(50))]
        assert suffix_dedup.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])
    part = "".join(rng.choice("abcdef ") for _ in range(300))
    rows = [(r.doc_id, r.text, None, None) for r in odd.collect()] + [(20 + i, "".join(rng.choice("xyz ") for _ in range(90 * i)) + part[i : 280 - i] + str(i) * 9, None, None) for i in range(6)]
    rows += [(40, "a" * 450, None, None), (41, "b" * 200, None, None), (42, "b" * 199, None, None)]
    texts = [(t or "").encode() for _, t, _, _ in rows]
    counts = {}
    for t in texts:
        for i in range(len(t) - 199):
            counts[t[i : i + 200]] = counts.get(t[i : i + 200], 0) + 1
    expected = []
    for (i, *_), t in zip(rows, texts):
        gone = np.zeros(len(t), dtype=bool)
        for k in range(len(t) - 199):
            if counts[t[k : k + 200]] > 1:
                gone[k : k + 200] = True
        expected.append((str(i), len(t), int(gone.sum()), int((np.diff(np.concatenate(([0], gone.astype(int), [0]))) == 1).sum()), bytes(b for b, g in zip(t, gone) if not g)))
    for hot in (4096, 1):
        got = suffix_dedup.dedup_bytes(documents(spark, rows), hot=hot).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == sorted(expected)


def test_bpe_equals_the_library(spark, odd):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    texts = ["It's <|endoftext|> fine", "ΑΣ İ é ½ ²", "x" * 3000, "a\x1cb\x85c", "日本語 12 😀👍🏽", "</w> don't", None, ""]
    rows = [(100 + i, t, None, None) for i, t in enumerate(texts)] + [(r.doc_id, r.text, None, None) for r in odd.collect()]
    for r in bpe.encode_documents(documents(spark, rows), path).collect():
        text = next((t or "" for i, t, _, _ in rows if i == r.doc_id and hashlib.sha256(" ".join(map(str, library.encode(t or "", add_special_tokens=False).ids)).encode()).hexdigest() == r.ids_sha256), None)
        assert text is not None
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False) and r.n_tokens == len(r.ids)


def test_warc_round_trip(spark):
    rows = [(1, "http://a/\r\nx", "<p>1</p>"), (2, None, "<p>1</p>"), (3, "u", None), (4, "u", ""), (5, "u", "z" * 200_000), (None, "u", "<p>1</p>"), (6, "u", "\r\n\r\nWARC/1.1\r\n")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    normal = warc.normalise(warc.write_archives(pages, archive_bytes=1000))
    got = {r.record_id: r for r in warc.read_records(normal).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        record = got[None if i is None else str(i)]
        payload = (html or "").encode()
        assert (record.payload_bytes, record.payload_digest) == (len(payload), warc.digest_of(payload))
        first = min(j for j, _, h in rows if j is not None and (h or "") == (html or ""))
        assert (record.record_type, record.refers_to) == (("response", None) if i == first else ("revisit", str(first)))
        if i == first:
            assert bytes(record.payload) == payload
    again = warc.normalise(normal.select("archive", "content"))
    assert {r.record_id for r in warc.read_records(again).collect()} == set(got)
    assert warc.read_records(warc.normalise(warc.write_archives(pages.limit(0)))).count() == 0


def test_jaccard_groups_equal_brute_force(spark, odd):
    rng = random.Random(9)
    base = [rng.choice(WORDS) for _ in range(150)]
    rows = [(r.doc_id, r.text, None, None) for r in odd.collect() if r.doc_id != 10]
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(1, 8)):
            words[rng.randrange(150)] = f"n{rng.randrange(999)}"
        rows.append((200 + i, " ".join(words), None, None))
    sets = {i: common.shingle_set((t or "").encode(), 4) for i, t, _, _ in rows if i is not None}
    root = {i: i for i in sets}
    for i in sets:
        for j in sets:
            both = len(np.intersect1d(sets[i], sets[j]))
            if i < j and both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root[i], root[j]
                root = {k: min(a, b) if v in (a, b) else v for k, v in root.items()}
    for size in (2048, 16):
        got = jaccard_join.jaccard_groups(documents(spark, rows), region_rows=size).collect()
        assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == root
        assert [r.component_id for r in got if r.doc_id is None] == [None]
    many = jaccard_join._Sets([sets[i] for i in sorted(sets) if len(sets[i])] * 6, 85, 100)
    many.join(np.arange(len(many.sizes)))
    n = len(many.sizes) // 6
    assert (many.root.reshape(6, n) == many.root[:n]).all()


def test_language_and_toxicity_learn(spark):
    rng = random.Random(4)
    pick = {"aa": "kalo timu reno", "bb": "zwix plork quen"}
    rows = [(i, " ".join(rng.choice(pick[lang].split()) for _ in range(30)) + (" vile" if i % 5 == 0 else ""), lang, "s") for i in range(200) for lang in [("aa", "bb")[i % 2]]]
    rows += [(900, None, None, "s"), (901, "123 !!", "aa", "s"), (None, "kalo timu", "aa", "s")]
    docs = documents(spark, rows)
    found = {r.doc_id: r for r in langid.identify(docs, langid.fit(docs.where("doc_id < 100"))).collect()}
    assert all(found[i].lang_pred == lang and 0 <= found[i].score <= 1 for i, _, lang, _ in rows[:200])
    assert found[900].lang_pred == found[901].lang_pred == "und" and found[None].lang_pred == "aa"
    assert {r.lang_pred for r in langid.identify(docs, langid.fit(docs.limit(0))).collect()} == {"und"}
    labels = docs.where("doc_id < 200").select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    fold = common.fold_of(F.col("doc_id"), 3)
    model = toxicity.fit(toxicity.labelled_sample(docs, labels, fold != 1, "toxic"))
    scored = {r.doc_id: r for r in toxicity.score_documents(docs, model, fold == 1).collect()}
    assert all(scored[i].predicted == int(i % 5 == 0) for i in range(200)) and 0 <= scored[900].score <= 1
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 40
    assert toxicity.fit(toxicity.labelled_sample(docs, labels.limit(0), fold != 1, "toxic")).score("x") == 0.5


def test_fuzzy_lines_keep_one_of_each_group(spark):
    line = "The quick brown fox jumps over the lazy dog while seven wizards watch from a distant hill, number "
    rows = [(1, f"{line}one\n\nunique first", None, None), (2, f"{line}two\nunique second\n{line}two", None, None), (3, None, None, None), (4, "", None, None),
            (None, f"{line}one", None, None), (5, "unique first", None, None), (5, "unique first", None, None), (6, "ü" * 500 + "\nab", None, None), (7, "ab", None, None)]
    got = sorted(((r.doc_id or 0, r.text, r.n_lines, r.n_removed) for r in fuzzy_lines.dedup_lines(documents(spark, rows)).collect()), key=str)
    assert got == sorted([(1, f"{line}one\n\nunique first", 2, 0), (2, "unique second", 3, 2), (3, None, 0, 0), (4, "", 0, 0), (0, "", 1, 1), (5, "", 1, 1), (5, "", 1, 1),
                          (6, "ü" * 500 + "\nab", 2, 0), (7, "", 1, 1)], key=str)
    kept = fuzzy_lines.deduplicated_documents(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns and kept.count() == len(rows)
    assert fuzzy_lines.dedup_lines(documents(spark, rows).limit(0)).count() == 0


def test_parities_never_exceed_the_difference():
    from symbolweave.llm import jaccard_join

    rng = np.random.default_rng(1)
    for n in (1, 2, 1023, 1024, 1025, 2047, 2049, 4200):
        first = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        second = np.unique(np.concatenate((first[: int(n * 0.93)], rng.integers(0, 2**63, n // 12 + 1).astype(np.uint64))))
        lengths, views = jaccard_join._parities([jaccard_join._parity(first), jaccard_join._parity(second)])
        place, bits = views[int(lengths.min())]
        assert np.bitwise_count(bits[place[0]] ^ bits[place[1]]).sum() <= len(np.setxor1d(first, second))


def test_verified_groups_equal_brute_force():
    from symbolweave.llm import jaccard_join

    rng = np.random.default_rng(5)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 4000, rng.integers(1, 160)).astype(np.uint64)
        for _ in range(rng.integers(1, 30)):
            other = base.copy()
            changed = int(len(other) * rng.uniform(0, 0.12))
            other[:changed] = rng.integers(0, 4000, changed)
            sets.append(np.unique(other))
    ids = rng.permutation(len(sets)).tolist()
    got = dict(zip(*jaccard_join._linked_rows(ids, sets, 85, 100)))
    least = list(ids)
    plain = [set(s.tolist()) for s in sets]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 185 * len(plain[i] & plain[j]) >= 85 * (len(plain[i]) + len(plain[j]))]
    moved = True
    while moved:
        moved = False
        for i, j in links:
            low = min(least[i], least[j])
            moved |= least[i] != low or least[j] != low
            least[i] = least[j] = low
    assert [got.get(i, i) for i in ids] == least


def test_lines_of_one_passage_find_their_near_copies(spark):
    """Many lines that share a passage and are not alike: their bands hold them all, and pairs among them are still found."""
    rng = random.Random(11)
    say = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))
    passage, rows, pairs = say(12), [], []
    for i in range(120):
        line = f"{passage} {say(16)}"
        rows.append((2 * i, line, None, None))
        if i % 3 == 0:
            rows.append((2 * i + 1, line[:-6] + say(1), None, None))
            pairs.append(2 * i + 1)
    got = {r.doc_id: r.n_removed for r in fuzzy_lines.dedup_lines(documents(spark, rows)).collect()}
    assert all(got[i] == 0 for i in got if i not in pairs)
    assert sum(got[i] for i in pairs) == len(pairs)


def test_short_lines_find_their_near_copies(spark):
    pairs = [("Click here", "Click here!"), ("Read more here", "Read more here."), ("Next page", "Next page."), ("Sign in now", "Sign in now?")]
    rows = [(2 * i + k, line, None, None) for i, pair in enumerate(pairs) for k, line in enumerate(pair)] + [(90, "Next stage", None, None), (91, "Click", None, None)]
    got = {r.doc_id: r.n_removed for r in fuzzy_lines.dedup_lines(documents(spark, rows)).collect()}
    assert got == {**{2 * i: 0 for i in range(4)}, **{2 * i + 1: 1 for i in range(4)}, 90: 0, 91: 0}


@pytest.fixture(scope="module")
def crowded(spark):
    """Lines in groups: v variants of one line, p lines of one passage, d the same shingles at unequal length; and how many of each go."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8)))
    base, lines, k = [word() for _ in range(30)], [], 0
    for _ in range(500):
        varied = list(base)
        for i in rng.sample(range(30), 2):
            varied[i] = word()
        lines.append(("v", " ".join(varied)))
    passage = " ".join(word() for _ in range(12))
    while k < 750:
        tail = [word() for _ in range(14)]
        for _ in range(rng.choice((1, 2, 3))):
            varied = list(tail)
            for i in rng.sample(range(14), 2):
                varied[i] = word()
            lines.append(("p", passage + " " + " ".join(varied)))
            k += 1
    lines += [("d", line) for line in ("-" * 10, "-" * 30, "alpha beta gamma delta " * 3, "alpha beta gamma delta " * 10)]
    rows = [(i, line, None, None) for i, (_, line) in enumerate(lines)]
    got = {r.doc_id: r.n_removed for r in fuzzy_lines.dedup_lines(documents(spark, rows)).select("doc_id", "n_removed").collect()}
    return lines, {g: sum(got[i] for i, (h, _) in enumerate(lines) if h == g) for g in "vpd"}


def test_lines_left_of_a_band_meet(crowded):
    assert crowded[1]["v"] >= 350


def test_crowded_bands_equal_brute_force(crowded):
    lines, removed = crowded
    for group in "vp":
        sets = [{line[i : i + 5] for i in range(len(line) - 4)} for h, line in lines if h == group]
        parent = list(range(len(sets)))

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for i in range(len(sets)):
            for j in range(i):
                if 180 * len(sets[i] & sets[j]) >= 80 * (len(sets[i]) + len(sets[j])):
                    parent[root(i)] = root(j)
        assert removed[group] == len(sets) - len({root(i) for i in range(len(sets))})


def test_lines_of_the_same_shingles_link_at_any_length(crowded):
    assert crowded[1]["d"] == 2


def test_toxicity_learns_from_late_passages(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(7500)) + (" vile slur" if i % 2 else ""), "en", "s") for i in range(24)]
    assert min(len(text) for _, text, _, _ in rows) > 20_010
    docs = documents(spark, rows)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = toxicity.fit(toxicity.labelled_sample(docs, labels, F.col("doc_id") < 16, "toxic"))
    assert all((model.score(text) > 0.5) == bool(i % 2) for i, text, _, _ in rows)


def test_languages_are_learnt_from_whole_texts(spark):
    rng = random.Random(9)
    pick = {"aa": ["kalo", "timu", "reno"], "bb": ["zwix", "plork", "quen"]}
    rows = [(i, "12 " * 400 + " ".join(rng.choice(pick[lang]) for _ in range(30)), lang, "s") for i in range(20) for lang in [("aa", "bb")[i % 2]]]
    docs = documents(spark, rows)
    for parser in (langid.fit(docs), langid.fit(docs, sample_rows=3, language_chars=10)):
        assert {r.doc_id: r.lang_pred for r in langid.identify(docs, parser).collect()} == {i: lang for i, _, lang, _ in rows}
