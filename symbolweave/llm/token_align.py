"""Alignment of two tokenizers over a corpus: each distinct text is tokenised and aligned once and counts as often as it occurs."""

import hashlib
import json
import os
import re
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from symbolweave.llm.bpe import byte_letters
from symbolweave.llm.common import stored

# A space between two printable characters: no token of either vocabulary reaches over it, so what lies between two is a piece.
CUT = re.compile("(?<=[!-~À-ɏ]) (?=[!-~À-ɏ])")
INNER = re.compile("[!-~À-ɏ]{1,2}")
BLOCK_CHARS, BATCH_CHARS, CACHE_PIECES, BATCH = 65_536, 500_000, 250_000, 512
# Fixed value: the pattern by which byte-level vocabularies split a text.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BROADCAST_PAIRS = 1_000_000
MARK = "▁"


class Aligner:
    """Tokenises pieces of text by a byte-level BPE (A) and a sentence-piece model (B) and aligns them by bytes.

    Pieces are independent where A splits before a space by its fixed pattern and no token of B holds a space after other
    characters; other vocabularies are refused. So the pieces of some texts that are not known yet are encoded as one text
    and taken apart again, and what is known of a piece is kept: its counts, its groups as text and its linked pairs. Of a
    full cache the more used half stays.
    """

    def __init__(self, first: str, second: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(first)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=second)
        values = {c: i for i, c in enumerate(byte_letters())}
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        vocab = self.a.get_vocab()
        bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            bytes_a[i] = token.encode() if token in special else bytes(values[c] for c in token)
        bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.width = len(bytes_b)
        spec = json.loads(first)
        split = spec["pre_tokenizer"] or {}
        if split.get("type") != "ByteLevel" or not split.get("use_regex", True) or split.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("the first vocabulary does not split texts by the byte-level pattern alone")
        if b"" in bytes_a or b"" in bytes_b or any(b" " in t.lstrip(b" ") for t in bytes_b):
            raise ValueError("a token holds a space after other characters, or nothing")
        if len(bytes_a) * self.width >= 1 << 63:
            raise ValueError("vocabularies too large for one number per pair")
        self._encode = self._encoder(spec, bytes_a, special)
        self.tokens = bytes_a, bytes_b
        self.lengths = tuple(np.array([len(t) for t in side], dtype=np.int64) for side in self.tokens)
        # Ids as text, followed by what follows a token inside its side of a group and at its end.
        self.shown = tuple(
            np.array([f"{i}{mark}" for mark in marks for i in range(len(side))], dtype=object)
            for side, marks in zip(self.tokens, (",|", ",;"))
        )
        self.digits = tuple(np.array([len(t) for t in side], dtype=np.int64) for side in self.shown)
        self._forget()

    def _encoder(self, spec, bytes_a, special):
        """Ids of a text by A. Where merges stand in the order of the ids they make, ranks alone say what is merged first
        and give the same ids sooner; other vocabularies are left to their own library."""
        made = [m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in spec["model"]["merges"]]
        order = [spec["model"]["vocab"].get(t, -1) for t in made]
        if -1 in order or order != sorted(set(order)):
            return lambda text: self.a.encode(text, add_special_tokens=False).ids
        import tiktoken

        names = {i for t, i in spec["model"]["vocab"].items() if t in special}
        ranks = {token: i for i, token in enumerate(bytes_a) if i not in names and token}
        return tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _forget(self):
        self.slots, self.groups = {}, []
        self.counts, self.uses = np.zeros((0, 3), dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.bad, self.pairs, self.ends = np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode()

    def _aligned(self, pieces: list[str]):
        """Counts, groups as text and pairs of pieces that stand one space apart; None if the tokens do not give them back."""
        text = " ".join(pieces)
        spaced = (" " + text).encode()
        ids = [np.array(self._encode(" " + text), dtype=np.int64), np.array(self.b.encode(text), dtype=np.int64)]
        if any(b"".join(map(side.__getitem__, part.tolist())) != spaced for side, part in zip(self.tokens, ids)):
            return None
        ends = [np.cumsum(length[part]) for length, part in zip(self.lengths, ids)]
        common = np.intersect1d(*ends, assume_unique=True)
        border = np.cumsum([len(p.encode()) + 1 for p in pieces])
        at = np.searchsorted(common, border)
        if at[-1] != len(common) - 1 or (common[at] != border).any():
            return None
        upto = np.stack([np.searchsorted(e, border) + 1 for e in ends] + [at + 1], axis=1)
        counts = np.diff(upto, axis=0, prepend=0)
        last = [np.searchsorted(e, common) for e in ends]
        pairs = ids[0][last[0]] * self.width + ids[1][last[1]]
        # Tokens in the order in which the groups are written: a group's A ids, then its B ids.
        group = [np.searchsorted(common, e) for e in ends]
        order = np.argsort(np.concatenate((2 * group[0], 2 * group[1] + 1)), kind="stable")
        closing = [np.isin(np.arange(len(part)), places) for part, places in zip(ids, last)]
        picked = [part + closes * len(side) for part, closes, side in zip(ids, closing, self.tokens)]
        words = np.concatenate([s[p] for s, p in zip(self.shown, picked)])[order]
        sizes = np.concatenate([d[p] for d, p in zip(self.digits, picked)])[order]
        written = "".join(words.tolist())
        cuts = np.concatenate(([0], np.cumsum(sizes)[upto[:, 0] + upto[:, 1] - 1])).tolist()
        return counts, [written[i : j - 1] for i, j in zip(cuts, cuts[1:])], pairs

    def _learn(self, pieces: list[str]) -> None:
        """Keep the alignment of new pieces. Those at the edge of a text, which may hold other spaces, stand alone."""
        apart = [p for p in pieces if not INNER.fullmatch(p[:1] + p[-1:]) or MARK in p]
        odd = set(apart)
        together = [p for p in pieces if p not in odd]
        batches = [together[i : i + 20_000] for i in range(0, len(together), 20_000)] + [[p] for p in apart]
        counts, bad, pairs, sizes = [self.counts], [self.bad], [self.pairs], [np.diff(self.ends)]
        while batches:
            batch = batches.pop()
            made = self._aligned(batch)
            if made is None and len(batch) > 1:
                half = len(batch) // 2
                batches += [batch[:half], batch[half:]]
                continue
            for p in batch:
                self.slots[p] = len(self.slots)
            if made is None:
                made = np.zeros((1, 3), dtype=np.int64), [""], np.zeros(0, dtype=np.int64)
                bad.append(np.ones(1, dtype=bool))
            else:
                bad.append(np.zeros(len(batch), dtype=bool))
            counts.append(made[0])
            self.groups += made[1]
            pairs.append(made[2])
            sizes.append(made[0][:, 2])
        self.counts, self.bad, self.pairs = np.concatenate(counts), np.concatenate(bad), np.concatenate(pairs)
        self.ends = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        self.uses = np.concatenate((self.uses, np.zeros(len(self.slots) - len(self.uses), dtype=np.int64)))

    def _linked(self, slots: np.ndarray) -> np.ndarray:
        """The linked pairs of pieces, one after the other."""
        start, size = self.ends[slots], self.ends[slots + 1] - self.ends[slots]
        return self.pairs[np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())]

    def _shrink(self) -> None:
        kept = np.sort(np.argsort(-self.uses, kind="stable")[: CACHE_PIECES // 2])
        pieces = list(self.slots)
        pairs = self._linked(kept)
        size = (self.ends[1:] - self.ends[:-1])[kept]
        self.slots = {pieces[k]: i for i, k in enumerate(kept.tolist())}
        self.groups = [self.groups[k] for k in kept.tolist()]
        self.counts, self.bad, self.uses = self.counts[kept], self.bad[kept], self.uses[kept] // 2
        self.pairs, self.ends = pairs, np.concatenate(([0], np.cumsum(size)))

    def blocks(self, blocks: list[str]):
        """For each block its counts, its groups as text and its pairs with how often each; None where bytes differ."""
        if len(self.slots) > CACHE_PIECES:
            self._shrink()
        split = [CUT.split(b) for b in blocks]
        known = self.slots
        if new := list(set(chain.from_iterable(split)).difference(known)):
            self._learn(new)
        for pieces in split:
            slots = np.fromiter(map(known.__getitem__, pieces), dtype=np.int64, count=len(pieces))
            np.add.at(self.uses, slots, 1)
            if self.bad[slots].any():
                yield None
            else:
                yield self.counts[slots].sum(axis=0), ";".join(map(self.groups.__getitem__, slots.tolist())), np.unique(self._linked(slots), return_counts=True)
    def texts(self, texts: list[str]):
        """``(n_a, n_b, n_groups, groups_sha256, pairs, times)`` of each whole text; None where bytes differ.

        Long texts are cut into blocks where pieces end, and blocks of several texts are looked up together, so memory
        does not grow with a text but for its distinct pairs.
        """
        made, waiting, size = [_Whole() for _ in texts], [], 0
        for i, text in enumerate(texts):
            start = 0
            while start < len(text) or start == 0:
                end = len(text)
                if start + BLOCK_CHARS < end and (cut := CUT.search(text, start + BLOCK_CHARS)):
                    end = cut.start()
                waiting.append((i, text[start:end]))
                size += end - start
                start = end + 1
                if size >= BATCH_CHARS:
                    self._add(made, waiting)
                    waiting, size = [], 0
        self._add(made, waiting)
        return [m.result() for m in made]

    def _add(self, made, waiting):
        for (i, _), part in zip(waiting, self.blocks([b for _, b in waiting])):
            made[i].add(part)


class _Whole:
    """What the blocks of one text add up to."""

    def __init__(self):
        self.counts, self.digest, self.first, self.failed = np.zeros(3, dtype=np.int64), hashlib.sha256(), True, False
        self.pairs, self.times = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def add(self, part):
        if part is None:
            self.failed = True
            return
        counts, groups, (pairs, times) = part
        self.counts += counts
        self.digest.update((groups if self.first else ";" + groups).encode())
        if self.first:
            self.pairs, self.times = pairs, times
        else:
            both, where = np.unique(np.concatenate((self.pairs, pairs)), return_inverse=True)
            sums = np.zeros(len(both), dtype=np.int64)
            np.add.at(sums, where, np.concatenate((self.times, times)))
            self.pairs, self.times = both, sums
        self.first = False

    def result(self):
        return None if self.failed else (*self.counts.tolist(), self.digest.hexdigest(), self.pairs, self.times)


@lru_cache(maxsize=2)
def _aligner(first: str, second: bytes) -> Aligner:
    return Aligner(first, second)


_ALIGNED = "digest binary, copies long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<long>"


def _aligned(batches, first, second):
    aligner = _aligner(first, second)
    names = ["digest", "copies", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"]
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH):
            part = batch.slice(start, BATCH)
            texts, copies = part.column("text").to_pylist(), part.column("copies").to_pylist()
            out = [(hashlib.sha256(t.encode()).digest(), n, *made) for t, n, made in zip(texts, copies, aligner.texts(texts)) if made]
            columns = list(zip(*out)) if out else [[]] * 8
            lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, c)]), pa.int32()), pa.array(np.concatenate(c or [np.zeros(0, dtype=np.int64)]))) for c in columns[6:]]
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds)), *lists], names=names)


class Alignment:
    """The alignment of all texts of ``documents(doc_id, text)`` by vocabulary files ``first`` (A) and ``second`` (B).

    Texts are counted by their whole content, so a text that many rows share is one row before it is shuffled, and rows of
    it meet its measures by digest, a join that can be split. ``pairs`` is ``(pair, n, best)``, one row per linked pair of
    ids, ``pair`` being ``a * size of B + b``, ``n`` its links in the corpus and ``best`` whether its B id has no pair with
    more. It is broadcast below ``BROADCAST_PAIRS`` rows, else shuffled. Null and empty texts, and texts that a vocabulary
    does not give back byte for byte, have zeros and an empty digest; null, repeated and any ids keep one row each.
    """

    def __init__(self, documents: DataFrame, first: str, second: str):
        with open(first, encoding="utf-8") as f:
            vocabulary = f.read()
        with open(second, "rb") as f:
            model = f.read()
        self.documents = documents.select("doc_id", "text")
        texts = self.documents.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
        self.texts = stored(texts.mapInArrow(partial(_aligned, first=vocabulary, second=model), _ALIGNED), "aligned-texts")
        self.width = _aligner(vocabulary, model).width
        linked = self._links().groupBy("pair").agg(F.sum(F.col("times") * F.col("copies")).alias("n"))
        counted = stored(linked.withColumn("b", F.col("pair") % self.width), "aligned-counts")
        most = counted.groupBy("b").agg(F.max("n").alias("most"))
        self.pairs = stored(counted.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "aligned-pairs")

    def _links(self) -> DataFrame:
        """One row per distinct pair of a text."""
        return self.texts.select("digest", "copies", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
            "digest", "copies", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))

    def measures(self) -> DataFrame:
        """One row per document: counts, links at their B id's highest, sum of link counts, digest of the groups."""
        pairs = F.broadcast(self.pairs) if self.pairs.count() <= BROADCAST_PAIRS else self.pairs
        scored = self._links().join(pairs, "pair").groupBy("digest").agg(
            F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"))
        whole = stored(self.texts.select("digest", "n_a", "n_b", "n_groups", "groups_sha256").join(scored, "digest"), "aligned-measures")
        keyed = self.documents.select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
        numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
        return keyed.join(whole, "digest", "left").select("doc_id", *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def align(documents: DataFrame, first: str, second: str) -> Alignment:
    return Alignment(documents, first, second)
