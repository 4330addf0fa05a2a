"""BPE encoding by backtracking over longest token matches, and decoding from an offset table."""

import hashlib
import json
import re
import unicodedata

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Fixed values of the tokenizer's format: white space, the split of words, the mark of a word's end.
WHITE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+"
WORD_END = "</w>"
_END = "\ue000"
CACHE_WORDS, CACHE_LENGTH, PAIRS = 700_000, 40, 500_000


def byte_letters() -> list[str]:
    """Letter that stands for each byte: printable Latin-1 as it is, the others from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Encoder:
    """Exact BPE of one vocabulary, from its JSON file.

    A token sequence is the result of merging exactly if each token is whole under merging and each neighbouring pair
    stays unmerged. So the encoder takes the longest token at each place, steps back to shorter ones where a pair is
    not compatible, and never visits a place from which no path leads on, twice. Pairs are decided once and kept.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids = {t.removesuffix(WORD_END) + _END * t.endswith(WORD_END): i for t, i in model["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merges = [tuple(p.removesuffix(WORD_END) + _END * p.endswith(WORD_END) for p in m) for m in merges]
        made = {a + b for a, b in merges}
        self.rank = {t: r for r, t in enumerate(t for t in self.ids if t not in made)}
        base = len(self.rank)
        self.text = list(self.rank)
        self.parts = [(r, r) for r in range(base)]
        self.merged = {}
        for a, b in merges:
            if a + b not in self.rank:
                self.rank[a + b] = len(self.text)
                self.text.append(a + b)
                self.parts.append((self.rank[a], self.rank[b]))
            self.merged.setdefault((self.rank[a], self.rank[b]), self.rank[a + b])
        self.pairs = {}
        self.shorter = {}
        tree = ahocorasick.Automaton()
        for r, t in enumerate(self.text):
            if self.parts[r] == (r, r) or self._whole(r):
                tree.add_word(t[::-1], r)
        tree.make_automaton()
        self.tree = tree
        self.length = [len(t) for t in self.text]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = regex.compile(WORDS).findall
        self.white = regex.compile(f"[{WHITE}]+")
        self.letters = byte_letters()
        names = {i: t for t, i in [*model["vocab"].items(), *self.special.items()]}
        size = max(names) + 1
        self.blob = "".join(names.get(i, "") for i in range(size))
        self.offsets = [0]
        for i in range(size):
            self.offsets.append(self.offsets[-1] + len(names.get(i, "")))
        self.cache = {}

    def _whole(self, r: int) -> bool:
        a, b = self.parts[r]
        return self.compatible(a, b, r)

    def compatible(self, left: int, right: int, below: int | None = None) -> bool:
        """True if merging the two tokens' text leaves them as they are, looking at merges earlier than ``below``."""
        a, b, limit, good = left, right, 1 << 60 if below is None else below, True
        while True:
            joined = self.merged.get((a, b))
            if joined is not None and joined < limit:
                good = False
                break
            # Undo the later of the two merges: the pair that met before it must not have merged earlier.
            (a0, a1), (b0, b1) = self.parts[a], self.parts[b]
            if a > b:
                if a1 != a:
                    limit, a = a, a1
                elif b0 != b:
                    limit, b = b + 1, b0
                else:
                    break
            elif b0 != b:
                limit, b = b + 1, b0
            elif a1 != a:
                limit, a = a, a1
            else:
                break
        if below is None and len(self.pairs) < PAIRS:
            self.pairs[left << 20 | right] = good
        return good

    def _prefix(self, r: int) -> int:
        """Longest token that is a proper beginning of this one, or -1."""
        found = self.shorter.get(r)
        if found is None:
            text, found = self.text[r], -1
            for n in range(len(text) - 1, 0, -1):
                p = self.rank.get(text[:n])
                if p is not None and (self.parts[p] == (p, p) or self._whole(p)):
                    found = p
                    break
            self.shorter[r] = found
        return found

    def encode_word(self, word: str) -> list[int]:
        """Ranks of the tokens of one word in byte letters; letters outside the vocabulary are left out."""
        word += _END
        # A byte letter and the end mark after it are one base token, as are all other byte letters.
        n = len(word)
        longest, length = [-1] * n, self.length
        for end, r in self.tree.iter(word[::-1]):
            at = n - 1 - end
            if longest[at] < 0 or length[r] > length[longest[at]]:
                longest[at] = r
        tokens, open_at, at, token = [], bytearray(b"\1") * (n + 1), 0, longest[0]
        pairs, prefix = self.pairs, self.shorter
        while at < n:
            last = tokens[-1] << 20 if tokens else -1
            while token >= 0:
                end = at + length[token]
                if open_at[end]:
                    if last < 0:
                        break
                    good = pairs.get(last | token)
                    if self.compatible(last >> 20, token) if good is None else good:
                        break
                shorter = prefix.get(token)
                token = self._prefix(token) if shorter is None else shorter
            if token >= 0:
                tokens.append(token)
                at = end
                token = longest[at] if at < n else -1
            elif tokens:
                open_at[at] = 0
                token = tokens.pop()
                at -= length[token]
            else:
                raise ValueError(f"no tokens for {word[:40]!r}")
        return tokens

    def _encoded(self, word: str) -> str:
        """Ids of one word as text."""
        letters = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode("utf-8")))
        if word.isascii() and not word.isprintable():
            letters = "".join(map(self.letters.__getitem__, word.encode("utf-8")))
        return " ".join(str(self.ids[self.text[r]]) for r in self.encode_word(letters))

    def normal(self, text: str) -> str:
        """The text as the vocabulary's normaliser leaves it: composed, single spaces, lower case."""
        return self.white.sub(" ", unicodedata.normalize("NFC", text)).replace("Σ", "σ").lower()

    def encode(self, text: str) -> list[str]:
        """Ids of a text, as decimal text, several of a word in one entry."""
        out, cache = [], self.cache
        for piece in self.at_special.split(text) if self.at_special else [text]:
            if piece in self.special:
                out.append(str(self.special[piece]))
                continue
            for word in self.words(self.normal(piece)):
                ids = cache.get(word)
                if ids is None:
                    ids = self._encoded(word)
                    if len(word) <= CACHE_LENGTH:
                        if len(cache) >= CACHE_WORDS:
                            cache.clear()
                        cache[word] = ids
                out.append(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        """Tokens of the ids, joined by one space, cut from the offset table."""
        blob, at = self.blob, self.offsets
        return " ".join([blob[at[i] : at[i + 1]] for i in ids])


_ENCODERS = {}


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, built once per worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_documents(documents: DataFrame, path: str, keep_ids: bool = True) -> DataFrame:
    """Per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, with ``keep_ids``, ``ids`` and ``decoded``.

    ``path`` is the vocabulary file on every executor. Whole texts are read, in Arrow batches, without a shuffle; a
    null text counts as empty and gives no tokens. Rows with equal or null ids stay rows of their own; other columns
    are not read.
    """
    kept = ", ids array<int>, decoded string" if keep_ids else ""

    def run(batches):
        work = encoder(path)
        for batch in batches:
            out = {k: [] for k in ("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")}
            for text in batch.column(1).to_pylist():
                joined = " ".join(work.encode(text or ""))
                ids = list(map(int, joined.split(" "))) if joined else []
                decoded = work.decode(ids)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                if keep_ids:
                    out["ids"].append(ids)
                    out["decoded"].append(decoded)
            columns = [batch.column(0), pa.array(out["n_tokens"], pa.int64()), pa.array(out["ids_sha256"], pa.string()), pa.array(out["decoded_sha256"], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns += [pa.array(out["ids"], pa.list_(pa.int32())), pa.array(out["decoded"], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{kept}"
    return documents.select("doc_id", "text").mapInArrow(run, schema)
