"""Cross-tokenizer alignment against both libraries on whole texts."""

import hashlib
import random
from collections import Counter

import pytest

pytest.importorskip("symbolweave.llm")
tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

import public_tokenizers  # noqa: E402

from symbolweave.llm import token_align  # noqa: E402
from symbolweave.llm.bpe import byte_letters  # noqa: E402

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(rows):
    a_lib = tokenizers.Tokenizer.from_file(PATHS[0])
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    values = {c: i for i, c in enumerate(byte_letters())}
    b_bytes = lambda i: bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode()
    made, counts = {}, Counter()
    for i, text in rows:
        if not text:
            continue
        a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
        parts = [[bytes(values[c] for c in a_lib.id_to_token(t)) for t in a], [b_bytes(t) for t in b]]
        if any(b"".join(p) != (" " + text).encode() for p in parts):
            continue
        ends = [[sum(map(len, p[: k + 1])) for k in range(len(p))] for p in parts]
        links = [(a[i], b[ends[1].index(e)]) for i, e in enumerate(ends[0]) if e in ends[1]]
        groups, before = [], 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            groups.append("|".join(",".join(str(t) for t, x in zip(ids, at) if before < x <= e) for ids, at in zip((a, b), ends)))
            before = e
        counts.update(links)
        made[i] = len(a), len(b), links, groups
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    out = {}
    for i, _ in rows:
        if i in made:
            n_a, n_b, links, groups = made[i]
            out[i] = (n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
                      hashlib.sha256(";".join(groups).encode()).hexdigest())
        else:
            out[i] = (0,) * 6 + ("",)
    return out


def rows_of(df):
    return sorted(((r.doc_id, (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = ["alpha", "Beta,", "don't", "naïve", "日本語", "x=1;", "😀", "antidisestablishmentarianism", "▁", "a b", "\x1c", "12345", "Ünder", "́e"]
    texts = [None, "", " ", "  lead", "trail  ", "a  b", "a\n b\t\tc", "<|endoftext|> x", "<s> </s> <unk> <0x0A>", "▁mark", "ﬁ ligature", "a\x00b", "one two"]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 12))) for _ in range(60)]
    texts += ["".join(rng.choice("ab \n\té .\x85'") for _ in range(rng.randrange(30))) for _ in range(120)]
    texts += ["same text here"] * 9
    return [(i, t) for i, t in enumerate(texts)]


def test_measures_equal_whole_texts(spark, rows, monkeypatch):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, digest string, copies int")
    want = sorted(plain(rows).items(), key=str)
    assert any(w[1][0] == 0 for w in want[3:])
    assert rows_of(token_align.align(df, *PATHS).measures()) == want
    monkeypatch.setattr(token_align, "BROADCAST_PAIRS", 0)
    assert rows_of(token_align.align(df, *PATHS).measures()) == want
    assert token_align.align(df.limit(0), *PATHS).measures().count() == 0


def test_repeated_and_null_ids_keep_their_rows(spark):
    df = spark.createDataFrame([(None, "one two"), (None, "one two"), (4, "one two"), (4, None)], "doc_id bigint, text string")
    got = rows_of(token_align.align(df, *PATHS).measures())
    assert len(got) == 4 and len({g[1] for g in got if g[1][0]}) == 1 and sum(g[1][0] > 0 for g in got) == 3


def test_blocks_and_cache_do_not_change_a_text(monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choice(["word ", "Two ", "naïve\n", "1 ", "  ", "long-winded ", "　"]) for _ in range(600))
    read = lambda: token_align.Aligner(open(PATHS[0], encoding="utf-8").read(), open(PATHS[1], "rb").read()).texts([text, "one", text])[2]
    whole = read()
    monkeypatch.setattr(token_align, "BLOCK_CHARS", 50)
    monkeypatch.setattr(token_align, "CACHE_PIECES", 4)
    monkeypatch.setattr(token_align, "BATCH_CHARS", 120)
    shrunk = []
    shrink = token_align.Aligner._shrink
    monkeypatch.setattr(token_align.Aligner, "_shrink", lambda self: (shrink(self), shrunk.append(len(self.slots))))
    parts = read()
    assert shrunk and max(shrunk) == 2
    assert whole[:4] == parts[:4] and all((x == y).all() for x, y in zip(whole[4:], parts[4:]))
    assert whole[:4] == (*plain([(0, text)])[0][:3], plain([(0, text)])[0][6])
