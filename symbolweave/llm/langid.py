"""Language identification by cross-parsing: the language whose text parses a document into fewest phrases wins."""

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_ROWS, LANGUAGE_CHARS, BLOCK, BATCH_CHARS = 96, 16_000, 256, 1 << 21
UNKNOWN = "und"


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the smallest automaton that reads every substring of ``text``; state 0 is the start."""
    moves, link, length, last = [{}], [-1], [0], 0
    for c in text:
        here = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = here
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] != length[p] + 1:
                copy = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[here] = copy
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
            else:
                link[here] = q
        last = here
    return moves


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """True for the code points of letters and marks."""
    return np.array([unicodedata.category(chr(i))[0] in "LM" for i in range(0x110000)])


@lru_cache(maxsize=1)
def _true_letters() -> np.ndarray:
    """True for the code points of letters alone."""
    return np.array([unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)])


def has_letter(codes: np.ndarray) -> bool:
    return bool(_true_letters()[codes].any())


def letters_only(text: str) -> np.ndarray:
    """Code points in lower case, every run of other characters than letters as one space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    good = _letters()[codes]
    keep = good.copy()
    keep[1:] |= good[:-1]
    return np.where(good, codes, 32)[keep]


class Parser:
    """Automata of all languages in one flat table: a state is the offset of its row, a row has a cell per letter."""

    def __init__(self, texts: dict[str, str]):
        self.languages = sorted(texts)
        self.letters, tables, self.roots, at = [], [], [], 0
        for language in self.languages:
            text = texts[language]
            order = sorted(set(text))
            moves = suffix_automaton(text)
            width = len(order) + 2  # cell 0 for unknown letters, cell 1 for the padding after a text's end
            table = np.full((len(moves), width), -1, dtype=np.int32)
            place = {c: i + 2 for i, c in enumerate(order)}
            for state, row in enumerate(moves):
                for c, to in row.items():
                    table[state, place[c]] = at + to * width
                table[state, 1] = at + state * width
            tables.append(table.ravel())
            self.roots.append(at)
            self.letters.append(np.array([ord(c) for c in order], dtype=np.uint32))
            at += table.size
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int32)
        self.weights = np.array([np.log2(max(2, len(texts[n]))) for n in self.languages])

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of phrases of each text by each language: longest matches one after the other, an unknown letter alone.

        Texts are cut into blocks of fixed length that are parsed side by side, one letter a step, at first all from the
        start state. Then each block is parsed again from the state in which the one before it ends, until it comes to
        where it was at first; a block that never does is parsed whole, and the next one after it.
        """
        lengths = np.array([len(t) for t in texts])
        blocks = -(-lengths // BLOCK)
        padded = np.zeros(int(blocks.sum()) * BLOCK, dtype=np.uint32)
        starts = np.concatenate(([0], np.cumsum(blocks)))[:-1] * BLOCK
        for at, t in zip(starts, texts):
            padded[at : at + len(t)] = t
        steps = padded.reshape(-1, BLOCK).T
        owner = np.repeat(np.arange(len(texts)), blocks)
        first = np.concatenate(([True], owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, dtype=bool)
        out = np.zeros((len(texts), len(self.languages)))
        for n, (root, letters) in enumerate(zip(self.roots, self.letters)):
            cells = np.clip(np.searchsorted(letters, steps), 0, len(letters) - 1)
            cells = np.where(letters[cells] == steps, cells + 2, 0).astype(np.int32)
            cells[steps == 0] = 1
            states, counts = np.empty_like(cells), np.empty_like(cells)
            state, count = np.full(steps.shape[1], root, dtype=np.int32), np.zeros(steps.shape[1], dtype=np.int32)
            for t, row in enumerate(cells):
                state, count = self._step(root, state, count, row)
                states[t], counts[t] = state, count
            total, end = count.copy(), state.copy()
            again = np.flatnonzero(~first[1:] & (end[:-1] != root)) + 1
            whole: list = []
            state, count = end[again - 1], np.zeros(len(again), dtype=np.int32)
            for t in range(BLOCK):
                if not len(again):
                    break
                state, count = self._step(root, state, count, cells[t, again])
                met = state == states[t, again]
                total[again[met]] = count[met] + counts[-1, again[met]] - counts[t, again[met]]
                again, state, count = again[~met], state[~met], count[~met]
            for at, s, c in zip(again, state, count):
                total[at], end[at] = c, s
                whole.append(at + 1)
            # In order, so that a block is parsed after the one that changed before it.
            while whole:
                at = whole.pop(0)
                if at >= len(owner) or first[at]:
                    continue
                state, count = end[at - 1 : at], np.zeros(1, dtype=np.int32)
                for t in range(BLOCK):
                    state, count = self._step(root, state, count, cells[t, at : at + 1])
                total[at] = count[0]
                if state[0] != end[at]:
                    end[at] = state[0]
                    whole.insert(0, at + 1)
            last = np.append(first[1:], True) if len(owner) else first
            total += last & (end != root)
            out[:, n] = np.bincount(owner, weights=total, minlength=len(texts))
        return out

    def _step(self, root, state, count, row):
        """States and phrases after one more letter each: a phrase ends where it cannot go on, an unknown letter is one more."""
        to = self.table[state + row]
        miss = to < 0
        if miss.any():
            fresh = self.table[root + row[miss]]
            unknown = fresh < 0
            count = count + miss
            count[miss] += unknown & (state[miss] != root)
            to[miss] = np.where(unknown, root, fresh)
        return to, count

    def classify(self, texts: list[np.ndarray]) -> list[tuple[str, float]]:
        """Language and score of texts with letters: the share by which the best parse is shorter than the second."""
        rates = self.phrases(texts) * self.weights
        order = np.argsort(rates, axis=1, kind="stable")
        out = []
        for row, by in zip(rates, order):
            second = row[by[1]] if len(by) > 1 else 0.0
            out.append((self.languages[by[0]], float(1 - row[by[0]] / second) if second else 1.0))
        return out


def fit(rows: DataFrame, language: str = "lang", sample_rows: int = SAMPLE_ROWS, language_chars: int = LANGUAGE_CHARS) -> Parser:
    """Automata from whole texts of a bounded sample of ``rows(doc_id, text, lang)`` with a language.

    Per language the ``sample_rows`` different texts with the smallest hashed ids are looked at, and in that order those
    are learnt, uncut, that fit into ``language_chars`` characters together, or the shortest if none does.
    """
    named = rows.where(F.col(language).isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        F.col(language).alias("lang"), F.xxhash64(F.col("doc_id").cast("string")).alias("h"), F.xxhash64("text").alias("copy"), F.length("text").alias("n"), "text")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "copy"))
    different = named.groupBy("lang", "copy").agg(F.min("h").alias("h"), F.min("n").alias("n"))
    drawn: dict[str, list] = {}
    for row in different.withColumn("place", place).where(F.col("place") <= sample_rows).orderBy("lang", "place").collect():
        drawn.setdefault(row["lang"], []).append(row)
    taken = []
    for of_language in drawn.values():
        room, before = language_chars, len(taken)
        for row in of_language:
            if row["n"] <= room:
                taken.append((row["lang"], row["copy"]))
                room -= row["n"]
        if len(taken) == before:
            taken.append(min((r["n"], i, r["lang"], r["copy"]) for i, r in enumerate(of_language))[2:])
    whole = named.where(F.col("copy").isin([copy for _, copy in taken])).groupBy("lang", "copy").agg(F.min("text").alias("text"))
    found = {(row["lang"], row["copy"]): row["text"] for row in whole.collect()}
    texts: dict[str, list[str]] = {}
    for lang, copy in taken:
        texts.setdefault(lang, []).append("".join(map(chr, letters_only(found[lang, copy]))))
    return Parser({k: " ".join(v) for k, v in texts.items() if any(c != " " for c in "".join(v))})


def identify(documents: DataFrame, parser: Parser, held_out: Column | None = None) -> DataFrame:
    """Per document: ``doc_id, held_out, lang_pred, score`` of its whole text.

    A null text, one without a letter (marks alone are none), and every text if nothing was learnt, is ``und`` with score 0. Ties go to the
    language first by name. Rows with equal or null ids are rows of their own; other columns are not read.
    """
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(parser)
    held = F.lit(None).cast("boolean") if held_out is None else held_out

    def run(batches):
        work = shared.value
        for batch in batches:
            found: list = [(UNKNOWN, 0.0)] * batch.num_rows
            at, held_texts, size = [], [], 0
            for i, text in enumerate(batch.column(2)):
                codes = letters_only(text.as_py() or "")
                if work.languages and has_letter(codes):
                    at.append(i)
                    held_texts.append(codes)
                    size += len(codes)
                if size >= BATCH_CHARS:
                    for j, f in zip(at, work.classify(held_texts)):
                        found[j] = f
                    at, held_texts, size = [], [], 0
            if at:
                for j, f in zip(at, work.classify(held_texts)):
                    found[j] = f
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", held.alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
