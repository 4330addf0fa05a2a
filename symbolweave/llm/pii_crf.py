"""Personal data in whole texts: fixed patterns, and spans added by a semi-Markov conditional random field.

The field scores whole candidate spans of the parts of a text around digits and at-signs, so a span's digit count, check
sum, separators and neighbours count together. Dynamic programming over spans of at most ``MAX_TOKENS`` tokens chooses
boundaries and kinds of a part jointly, and sums over all segmentations for the probability of a chosen span.
"""

import hashlib
import math
import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from symbolweave.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
PART = LOCAL | frozenset("@()")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_QUAD = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_DIGITS = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SEED = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|.", re.S)
MAX_TOKENS, SAMPLE_PARTS, SAMPLE_CHARS, SURE = 40, 3000, 240, 0.9
ROUNDS, RATE, DECAY = 12, 0.4, 1e-4
NEXT_TO = (" ", ",", ";", ":")


def _octets(parts) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def luhn(digits: str) -> bool:
    """Whether the check digit fits: every second digit from the right counts twice, as the sum of its digits."""
    values = np.frombuffer(digits[::-1].encode(), dtype=np.uint8).astype(int) - 48
    values[1::2] = values[1::2] * 2 - 9 * (values[1::2] > 4)
    return int(values.sum()) % 10 == 0


def _number(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """``(kind, start, end)`` of the fixed patterns, and the spans of matches that fail.

    The patterns are searched from what is rare, at-signs and ends of digit runs, which gives the leftmost matches in time
    linear in the text: a part before an at-sign is the whole run before it that no earlier match took.
    """
    found, failed, floor = [], [], 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > floor and text[start - 1] in LOCAL:
                start -= 1
            if start < m.start():
                found.append((0, start, m.end()))
                floor = m.end()
    if not _SEED.search(text):
        return found, failed
    for m in _QUAD.finditer(text):
        found.append((1, *m.span())) if _octets(m.groups()) else failed.append(m.span())
    for kind, pattern, low, high in ((2, _DIGITS, 13, 19), (3, _PLUS, 9, 15)):
        if kind == 3 and "+" not in text:
            continue
        for m in pattern.finditer(text):
            digits = _number(m.group())
            if low <= len(digits) <= high and (kind == 3 or luhn(digits)):
                found.append((kind, *m.span()))
            elif len(digits) > high:
                failed.append(m.span())
    return found, failed


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def parts(text: str) -> list[tuple[int, int]]:
    """Spans around digits and at-signs: runs of the characters of candidates that hold one, those a single space apart together."""
    out, at = [], 0
    while m := _SEED.search(text, at):
        start = end = m.start()
        while start > at and text[start - 1] in PART:
            start -= 1
        while end < len(text) and text[end] in PART:
            end += 1
        if out and start - out[-1][1] == 1 and text[start - 1] == " ":
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
        at = end
    return out


def _kind_of(c: str) -> str:
    return "" if c in ("", " ", "\n", "\t", "\r") else "d" if c.isdigit() else "a" if c.isalpha() else c


def features(s: str, left: str, right: str) -> tuple[str, ...]:
    """Features of a whole span with the characters before and after it."""
    digits = _number(s)
    groups = re.findall(r"[0-9]+", s)
    marks = "".join(sorted({c for c in s if not c.isalnum()}))
    letters = any(c.isalpha() for c in s)
    out = ["one", f"n={min(len(digits), 20)}", f"g={min(len(groups), 6)}", f"m={marks}", f"l={_kind_of(left)}", f"r={_kind_of(right)}",
           f"ends={_kind_of(s[0])}{_kind_of(s[-1])}", f"letters={letters}", f"m={marks},n={min(len(digits), 20)},{letters}"]
    if not letters:
        out.append("shape=" + re.sub(r"[0-9]+", lambda m: str(min(len(m.group()), 9)), s)[:24])
        if 13 <= len(digits) <= 19 and set(marks) <= {" ", "-"}:
            out.append(f"check={luhn(digits)}")
        if len(groups) == 4 and marks == ".":
            out.append(f"octets={_octets(groups)}")
        if 9 <= len(digits) <= 15:
            out.append(f"phone={'+' in marks}{'(' in marks}")
    local, _, domain = s.partition("@")
    if domain and "@" not in domain and set(local) <= LOCAL and local and re.fullmatch(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", domain):
        out.append("address")
    return tuple(out)


class Part:
    """One part of a text as tokens and its candidate spans: those of at most ``MAX_TOKENS`` tokens with a digit or an at-sign."""

    def __init__(self, text: str, left: str = "", right: str = ""):
        self.text, tokens = text, [m.span() for m in _TOKEN.finditer(text)]
        self.starts, self.ends = [a for a, _ in tokens], [b for _, b in tokens]
        self.length, self.spans, self.features = len(tokens), [], []
        around = left + text + right
        seeds = [bool(_SEED.search(text, a, b)) for a, b in tokens]
        for i in range(self.length):
            if not (text[self.starts[i]].isalnum() or text[self.starts[i]] in "+("):
                continue
            seen = False
            for j in range(i, min(self.length, i + MAX_TOKENS)):
                seen |= seeds[j]
                if seen and text[self.ends[j] - 1].isalnum():
                    a, b = self.starts[i], self.ends[j]
                    shift = len(left)
                    self.spans.append((i, j + 1))
                    self.features.append(features(text[a:b], around[a + shift - 1 : a + shift] if a + shift else "", around[b + shift : b + shift + 1]))


def _sum(values) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values)) if top > -math.inf else top


class Field:
    """The field: a weight per feature and kind, and per pair of neighbouring kinds (the last kind is none of them)."""

    NONE = len(KINDS)

    def __init__(self, weights: dict[str, list[float]] | None = None, steps: list[list[float]] | None = None):
        self.weights = weights or {}
        self.steps = steps or [[0.0] * (self.NONE + 1) for _ in range(self.NONE + 1)]

    def scores(self, part: Part) -> list[list[float]]:
        zero = [0.0] * self.NONE
        return [[sum(c) for c in zip(zero, *(self.weights.get(f, zero) for f in fs))] for fs in part.features]

    def _arcs(self, part: Part):
        """Segments by their end: ``(start, kind, index of the span or -1)``."""
        arcs = [[] for _ in range(part.length + 1)]
        for t in range(part.length):
            arcs[t + 1].append((t, self.NONE, -1))
        for k, (i, j) in enumerate(part.spans):
            arcs[j] += [(i, kind, k) for kind in range(self.NONE)]
        return arcs

    def best(self, part: Part) -> list[tuple[int, int]]:
        """``(kind, span)`` of the best segmentation; of equal ones that with fewer spans."""
        scores, arcs = self.scores(part), self._arcs(part)
        top = [[(-math.inf, None)] * (self.NONE + 1) for _ in range(part.length + 1)]
        top[0][self.NONE] = (0.0, None)
        for t in range(1, part.length + 1):
            for start, kind, k in arcs[t]:
                own = scores[k][kind] if k >= 0 else 0.0
                for before in range(self.NONE + 1):
                    value = top[start][before][0] + self.steps[before][kind] + own
                    if value > top[t][kind][0]:
                        top[t][kind] = (value, (start, before, k))
        out, t = [], part.length
        kind = max(range(self.NONE + 1), key=lambda y: (top[t][y][0], y))
        while t:
            start, before, k = top[t][kind][1]
            if k >= 0:
                out.append((kind, k))
            t, kind = start, before
        return out[::-1]

    def expected(self, part: Part):
        """Log of the sum over all segmentations, the probability of each span as each kind and the expected neighbours."""
        scores, arcs, n = self.scores(part), self._arcs(part), self.NONE + 1
        ahead = [[-math.inf] * n for _ in range(part.length + 1)]
        ahead[0][self.NONE] = 0.0
        for t in range(1, part.length + 1):
            into = [[] for _ in range(n)]
            for start, kind, k in arcs[t]:
                own = scores[k][kind] if k >= 0 else 0.0
                into[kind] += [ahead[start][b] + self.steps[b][kind] + own for b in range(n)]
            ahead[t] = [_sum(v) if v else -math.inf for v in into]
        back = [[-math.inf] * n for _ in range(part.length + 1)]
        back[part.length] = [0.0] * n
        pending = [[[] for _ in range(n)] for _ in range(part.length + 1)]
        for t in range(part.length, 0, -1):
            if t < part.length:
                back[t] = [_sum(v) if v else -math.inf for v in pending[t]]
            for start, kind, k in arcs[t]:
                own = (scores[k][kind] if k >= 0 else 0.0) + back[t][kind]
                for b in range(n):
                    pending[start][b].append(self.steps[b][kind] + own)
        total = _sum(ahead[part.length])
        spans, steps = [[0.0] * self.NONE for _ in part.spans], [[0.0] * n for _ in range(n)]
        for t in range(1, part.length + 1):
            for start, kind, k in arcs[t]:
                own = (scores[k][kind] if k >= 0 else 0.0) + back[t][kind] - total
                for b in range(n):
                    if ahead[start][b] > -math.inf:
                        p = math.exp(ahead[start][b] + self.steps[b][kind] + own)
                        steps[b][kind] += p
                        if k >= 0:
                            spans[k][kind] += p
        return total, spans, steps

    def found(self, text: str, left: str, right: str, sure: float = SURE) -> list[tuple[int, int, int]]:
        """Spans of the best segmentation whose probability is at least ``sure``."""
        part = Part(text, left, right)
        chosen = self.best(part)
        if not chosen:
            return []
        _, spans, _ = self.expected(part)
        return [(kind, part.starts[part.spans[k][0]], part.ends[part.spans[k][1] - 1]) for kind, k in chosen if spans[k][kind] >= sure]


def train(examples: list[tuple[Part, dict[int, int], int]], rounds: int = ROUNDS) -> Field:
    """Field of highest penalised likelihood of ``(part, span index to kind, times)``, by adaptive gradient steps in a fixed order."""
    field, squares = Field(), {}
    for _ in range(rounds):
        for part, gold, times in examples:
            _, spans, steps = field.expected(part)
            weight, grads = 1.0 + math.log(times), {}
            for k, fs in enumerate(part.features):
                delta = [-p for p in spans[k]]
                if k in gold:
                    delta[gold[k]] += 1.0
                if max(map(abs, delta)) < 1e-4:
                    continue
                for f in fs:
                    grad = grads.setdefault(f, [0.0] * Field.NONE)
                    for y in range(Field.NONE):
                        grad[y] += weight * delta[y]
            for f, grad in grads.items():
                w, s = field.weights.setdefault(f, [0.0] * Field.NONE), squares.setdefault(f, [1e-6] * Field.NONE)
                for y, g in enumerate(grad):
                    g -= DECAY * w[y]
                    s[y] += g * g
                    w[y] += RATE * g / math.sqrt(s[y])
            ends = {part.spans[k][1]: (part.spans[k][0], y) for k, y in gold.items()}
            path, t = [], part.length
            while t:
                start, y = ends.get(t, (t - 1, Field.NONE))
                path.append(y)
                t = start
            for b, y in zip([Field.NONE, *path[::-1]], path[::-1]):
                steps[b][y] -= 1.0
            for b in range(Field.NONE + 1):
                for y in range(Field.NONE + 1):
                    g = -weight * steps[b][y] - DECAY * field.steps[b][y]
                    s = squares.setdefault((b, y), [1e-6])
                    s[0] += g * g
                    field.steps[b][y] += RATE * g / math.sqrt(s[0])
    return field


def examples(rows: list[tuple[str, str, str]]) -> list[tuple[Part, dict[int, int], int]]:
    """Training parts from ``(part, left, right)`` labelled by the fixed patterns.

    Parts with a match that fails for too many digits are left out: two numbers side by side look so. In their place,
    labelled spans of the sample are put side by side, and phone numbers are also shown without their country prefix, which
    is what the patterns alone do not find; parts without a label that read like those are unlabelled, not clean, and are
    left out too. Parts of equal tokens' features count once, with their number.
    """
    plain, spans, masks = [], [], set()
    mask = lambda s: re.sub("[0-9]", "0", s)
    for text, left, right in rows:
        found, failed = base_spans(text)
        if failed:
            continue
        taken, gold = [], []
        for kind, a, b in sorted(found):
            if all(b <= x or y <= a for x, y in taken):
                taken.append((a, b))
                gold.append((kind, a, b))
                spans.append((kind, text[a:b]))
        plain.append((text, left, right, gold))
    spans = list(dict.fromkeys(spans))[:400]
    made = []
    for n, (kind, text) in enumerate(spans):
        right = NEXT_TO[n % len(NEXT_TO)]
        if kind == 3 and (cut := re.match(r"\+[0-9]{1,3}[ .-]?(?=\()", text)):
            made.append((text[cut.end():], " ", right, [(3, 0, len(text) - cut.end())]))
            masks.add(mask(text[cut.end():]))
        other, more = spans[(n * 7 + 1) % len(spans)]
        made.append((f"{text} {more}", " ", right, [(kind, 0, len(text)), (other, len(text) + 1, len(text) + 1 + len(more))]))
    plain = made + [p for p in plain if p[3] or not any(m in mask(p[0]) for m in masks)]
    out = {}
    for text, left, right, gold in plain:
        part = Part(text, left, right)
        place = {(part.starts[i], part.ends[j - 1]): k for k, (i, j) in enumerate(part.spans)}
        if any((a, b) not in place for _, a, b in gold):
            continue
        labels = {place[a, b]: kind for kind, a, b in gold}
        key = (tuple(part.features), tuple(sorted(labels.items())))
        out[key] = (part, labels, out[key][2] + 1 if key in out else 1)
    return list(out.values())


_FOUND = "doc_id {}, n_email long, n_ip long, n_card long, n_phone long, base string, parts array<struct<start:int,text:string,left:string,right:string>>"


def _found(batches):
    part = pa.struct([("start", pa.int32()), ("text", pa.string()), ("left", pa.string()), ("right", pa.string())])
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            rows, out, kept = batch.slice(start, 512), [], []
            for text in rows.column("text"):
                text = text.as_py() or ""
                spans, _ = base_spans(text)
                out.append((*(sum(k == kind for k, _, _ in spans) for kind in range(len(KINDS))), written(spans)))
                kept.append([{"start": a, "text": text[a:b], "left": text[a - 1 : a] if a else "", "right": text[b : b + 1]} for a, b in parts(text)])
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.string()), pa.array(kept, pa.list_(part))],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base", "parts"])


def _read(base: str) -> list[tuple[int, int, int]]:
    return [(KINDS.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in base.split(",") if s)]


def _added(batches, field, sure):
    for batch in batches:
        spans, digests = [], []
        for base, pieces in zip(batch.column("base").to_pylist(), batch.column("parts").to_pylist()):
            digests.append(hashlib.sha256(base.encode()).hexdigest())
            if not pieces:
                spans.append(base)
                continue
            own = _read(base)
            taken, more = sorted((a, b) for _, a, b in own), []
            for p in pieces:
                near = [t for t in taken if t[1] > p["start"] and t[0] < p["start"] + len(p["text"])]
                if len(near) == 1 and near[0] == (p["start"], p["start"] + len(p["text"])):
                    continue
                for kind, a, b in field.found(p["text"], p["left"], p["right"], sure):
                    a, b = a + p["start"], b + p["start"]
                    if all(b <= x or y <= a for x, y in near):
                        more.append((kind, a, b))
            spans.append(written(own + more))
        numbers = [batch.column(f"n_{k}") for k in KINDS]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *numbers, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
            names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])


def fit(found: DataFrame, sample_parts: int = SAMPLE_PARTS, sample_chars: int = SAMPLE_CHARS) -> Field:
    """Field learnt from the ``sample_parts`` different parts of at most ``sample_chars`` characters with the smallest hashes."""
    every = found.select(F.explode("parts").alias("p")).select("p.text", "p.left", "p.right").where(F.length("text") <= sample_chars)
    # Copies share a hash, so a part that many texts hold takes one place of the sample.
    rows = every.distinct().orderBy(F.xxhash64("text", "left", "right"), "text", "left", "right").limit(sample_parts).collect()
    return train(examples([tuple(r) for r in rows]))


def find_spans(documents: DataFrame, sure: float = SURE, **sample) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)``: counts and digest of the fixed patterns, and all spans.

    Each whole text is read once; only its parts around digits and at-signs are kept for learning and for the field. The
    field's spans join those of the patterns where they overlap none. Null and empty texts have no spans; null, repeated
    and any ids keep one row each; an empty table gives no rows and a field without weights, which adds nothing; further
    columns are ignored. Nothing is shuffled but the sample.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    found = stored(documents.select("doc_id", "text").mapInArrow(_found, _FOUND.format(kind)), "pii-parts")
    field = fit(found, **sample)
    return found.mapInArrow(partial(_added, field=field, sure=sure), f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
