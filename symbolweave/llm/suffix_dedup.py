"""Removal of repeated byte strings: windows located by minimisers, decided in suffix arrays built by linear grouping."""

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from symbolweave.llm.common import finish, prefix_hash, span_hash, stored

LENGTH, GRAM = 200, 40
PIECE_BITS = 23
ARRAY_BYTES, HOT_CONTEXTS, YIELD_BYTES, SPLIT = 1 << 17, 4096, 1 << 22, 10


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of non-negative integers by linear grouping.

    Suffixes start in groups by first letter. Groups are taken in descending order; each suffix of the group gets a
    pointer to the last suffix before it that is in a smaller group, and those pointed at move, the more pointers the
    higher, into new groups right after their own. A group then holds the suffixes with one Lyndon prefix. The second
    pass walks the growing array: the suffix before each entry, and those along its pointers, come next in their groups.
    """
    letters = np.append(np.asarray(text, dtype=np.int64) + 1, 0)
    n = len(letters)
    counts = np.bincount(letters)
    # Counting places: the suffixes of one first letter follow each other, by position.
    by_letter = np.argsort(letters, kind="stable")
    starts = (np.cumsum(counts) - counts)[letters]
    ranks = np.empty(n, dtype=np.int64)
    ranks[by_letter] = np.arange(n)
    sizes = np.zeros(n, dtype=np.int64)
    sizes[(np.cumsum(counts) - counts)[counts > 0]] = counts[counts > 0]
    # Four bytes an entry, read and written one by one below.
    order, group, place, size = (array("i", a.astype(np.int32).tobytes()) for a in (by_letter, starts, ranks, sizes))
    before = array("i", [-1]) * n
    end = n - 1
    while end >= 0:
        start = group[order[end]]
        members = np.sort(np.frombuffer(order[start : end + 1], dtype=np.int32)).tolist()
        pointed: dict[int, int] = {}
        for s in members:
            p = s - 1
            while p >= 0 and group[p] >= start:
                p = before[p]
            before[s] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        end = start - 1
        by_count: dict[int, list[int]] = {}
        for p, k in pointed.items():
            by_count.setdefault(k, []).append(p)
        for k in _descending(by_count, len(members)):
            touched: dict[int, int] = {}
            for p in by_count[k]:
                own = group[p]
                size[own] -= 1
                last = own + size[own]
                # Swap p with the last of what its group keeps.
                other, at = order[last], place[p]
                order[at], place[other] = other, at
                order[last], place[p] = p, last
                touched[own] = touched.get(own, 0) + 1
            for own, moved in touched.items():
                first = own + size[own]
                size[first] = moved
                for r in range(first, first + moved):
                    group[order[r]] = first
    out = array("i", [-1]) * n
    out[0] = n - 1
    free = array("i", range(n))
    done = bytearray(n)
    done[n - 1] = 1
    free[group[n - 1]] += 1
    for r in range(n):
        j = out[r] - 1
        while j >= 0 and not done[j]:
            at = free[group[j]]
            free[group[j]] = at + 1
            out[at] = j
            done[j] = 1
            j = before[j]
    return out.tolist()[1:]


def _descending(found, most):
    """The keys, numbers up to ``most``, from the largest on; where they are dense no comparison is made."""
    return sorted(found, reverse=True) if len(found) * 8 < most else [k for k in range(most, 0, -1) if k in found]


def repeated_starts(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """For each of some distinct contexts: which windows of ``length`` bytes also start elsewhere in them."""
    joined = np.zeros(sum(len(c) + 1 for c in contexts), dtype=np.int16)
    data = np.zeros(len(joined), dtype=np.uint8)
    starts, at = [], 0
    for c in contexts:
        data[at : at + len(c)] = np.frombuffer(c, dtype=np.uint8)
        joined[at : at + len(c)] = data[at : at + len(c)].astype(np.int16) + 1
        starts.append(at)
        at += len(c) + 1
    order = np.array(suffix_array(joined.tolist()))
    good = np.zeros(len(joined), dtype=bool)
    for s, c in zip(starts, contexts):
        good[s : s + max(0, len(c) - length + 1)] = True
    prefix = prefix_hash(data)
    own = np.zeros(len(joined), dtype=np.uint64)
    at = np.flatnonzero(good)
    own[at] = span_hash(prefix, at, at + length)
    # Windows with equal bytes are neighbours in the suffix array.
    same = good[order[1:]] & good[order[:-1]] & (own[order[1:]] == own[order[:-1]])
    found = np.zeros(len(joined), dtype=bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return [found[s : s + max(0, len(c) - length + 1)] for s, c in zip(starts, contexts)]


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` keys, from running minima forwards and backwards in blocks."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, length: int, gram: int):
    """``(gram hash, context hash, first window, windows, gram's place after it)`` of the runs of windows that share a minimiser.

    Every window of ``length`` bytes has as its anchor the gram with the smallest hash in it, the first of equal ones:
    equal windows have equal anchors at the same offset, so only windows with equal anchors can be equal.
    """
    out = []
    step = (1 << PIECE_BITS) - length
    for piece in range(0, max(1, len(data) - length + 1), step):
        part = data[piece : piece + step + length - 1]
        if len(part) < length:
            break
        prefix = prefix_hash(part)
        at = np.arange(len(part) - gram + 1)
        own = span_hash(prefix, at, at + gram)
        mask = np.uint64((1 << PIECE_BITS) - 1)
        least = (_window_minima((own & ~mask) | at.astype(np.uint64), length - gram + 1) & mask).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        last = np.append(first[1:], len(least))
        context = finish(span_hash(prefix, first, last - 1 + length) + (least[first] - first).astype(np.uint64))
        out.append((own[least[first]].view(np.int64), context.view(np.int64), first + piece, last - first, least[first] - first))
    return [np.concatenate(x) for x in zip(*out)] if out else None


def _named(documents: DataFrame) -> DataFrame:
    """``row, doc_id, data``: the bytes of each text, and a digest of id and text as the row's name."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    name = F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce("text", F.lit(""))).cast("binary")))
    return documents.select(name.alias("row"), "doc_id", text.alias("data"))


def _located(rows: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1)):
                found = anchors(np.frombuffer(data.as_buffer(), dtype=np.uint8), length, gram) if len(data.as_buffer()) >= length else None
                if found is not None:
                    names = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(found[0]), np.int8)), pa.array([name.as_py()])).dictionary_decode()
                    yield pa.RecordBatch.from_arrays(
                        [names, pa.array(found[0]), pa.array(found[1]), pa.array(found[2].astype(np.int32)), pa.array(found[3].astype(np.int32)), pa.array(found[4].astype(np.int32))],
                        names=["row", "gram", "context", "at", "windows", "skip"])

    return rows.where(F.length("data") >= length).select("row", "data").mapInArrow(run, "row binary, gram bigint, context bigint, at int, windows int, skip int")


def _contexts(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``gram, context, n, skip, data`` of one occurrence of each context, cut from its text."""
    asked = wanted.groupBy("row").agg(F.collect_list(F.struct("gram", "context", "n", "at", "windows", "skip")).alias("asked"))

    names = ("gram", "context", "n", "skip", "data")

    def made(out):
        return pa.RecordBatch.from_arrays([pa.array(out[k], pa.binary() if k == "data" else pa.int64()) for k in names], names=list(names))

    def run(batches):
        out: dict[str, list] = {k: [] for k in names}
        size = 0
        for batch in batches:
            for data, asked in zip(batch.column(0), batch.column(1)):
                view = memoryview(data.as_buffer())
                for a in asked.as_py():
                    out["data"].append(bytes(view[a["at"] : a["at"] + a["windows"] - 1 + length]))
                    size += len(out["data"][-1])
                    for name in names[:4]:
                        out[name].append(a[name])
                    if size >= YIELD_BYTES:
                        yield made(out)
                        out, size = {k: [] for k in names}, 0
        yield made(out)

    return rows.dropDuplicates(["row"]).join(asked, "row").select("data", "asked").mapInArrow(run, "gram bigint, context bigint, n bigint, skip bigint, data binary")


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edges[0::2], edges[1::2] - edges[0::2]


def _agreeing(x: bytes, y: bytes) -> int:
    """How many bytes two strings have in common at their start, by halving."""
    low, high = 0, min(len(x), len(y))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if x[:mid] == y[:mid] else (low, mid - 1)
    return low


def _alike(contexts: list[tuple], length: int, gram: int) -> list[tuple[int, int] | None]:
    """The part of each context of one gram that can share a window with another; None if nothing can.

    A window holds the gram, some ``x`` of the ``length - gram`` bytes around it before the gram, and the rest after it.
    So two contexts that share one agree, for ``x`` rounded down to a multiple of ``SPLIT``, in so many bytes before the
    gram, and in all but ``SPLIT`` of the others after it. What no such window reaches is left out.
    """
    around = length - gram
    if len(contexts) == 2:  # what the two agree in, to the byte
        (_, _, p, x), (_, _, q, y) = contexts
        before, after = _agreeing(x[:p][::-1], y[:q][::-1]), _agreeing(x[p + gram :], y[q + gram :])
        if before + after < around:
            return [None, None]
        return [(skip - before, skip + gram + after) for skip in (p, q)]
    sides = [(x, max(0, around - x - SPLIT)) for x in range(0, around + 1, SPLIT)]
    keys, counts = [], {}
    for _, _, skip, data in contexts:
        after, end = len(data) - skip - gram, skip + gram
        own = [(x, data[skip - x : skip] + data[end : end + y]) for x, y in sides if x <= skip and y <= after]
        keys.append(own)
        for key in own:
            counts[key] = counts.get(key, 0) + 1
    out = []
    for (_, _, skip, data), own in zip(contexts, keys):
        shared = [key[0] for key in own if counts[key] > 1]
        out.append((max(0, skip - shared[-1] - SPLIT), min(len(data), skip + gram + around - shared[0])) if shared else None)
    return out


def _decided(contexts: DataFrame, length: int, gram_length: int) -> DataFrame:
    """``gram, context, skip, windows``: the runs of windows of each context that occur elsewhere.

    Contexts come sorted by gram, so a gram's are decided in one suffix array, several grams in one of about
    ``ARRAY_BYTES``. Contexts that no other one of their gram can match stay out of it.
    """
    def decide(held, alone):
        out: dict[str, list] = {"gram": [], "context": [], "skip": [], "windows": []}
        for (gram, context, at, _), flags in zip(held, repeated_starts([h[3] for h in held], length) if held else []):
            skip, windows = _runs(flags)
            out["gram"] += [gram] * len(skip)
            out["context"] += [context] * len(skip)
            out["skip"] += (skip + at).tolist()
            out["windows"] += windows.tolist()
        for gram, context, windows in alone:
            out["gram"].append(gram)
            out["context"].append(context)
            out["skip"].append(0)
            out["windows"].append(windows)
        return pa.RecordBatch.from_arrays([pa.array(out[k], pa.int64() if k in ("gram", "context") else pa.int32()) for k in out], names=list(out))

    def run(batches):
        held: list = []
        alone: list = []
        own: list = []
        last = None

        def close():
            for (context, n, _, data), part in zip(own, _alike(own, length, gram_length)):
                if n > 1:  # every window of it occurs elsewhere
                    alone.append((last, context, len(data) - length + 1))
                if part:
                    held.append((last, context, part[0], data[part[0] : part[1]]))
            own.clear()

        for batch in batches:
            for gram, *context in zip(*(c.to_pylist() for c in batch.columns)):
                if gram != last:
                    close()
                    if sum(len(h[3]) for h in held) >= ARRAY_BYTES or len(alone) >= HOT_CONTEXTS:
                        yield decide(held, alone)
                        held, alone = [], []
                own.append(tuple(context))
                last = gram
        close()
        yield decide(held, alone)

    dealt = contexts.repartition("gram").sortWithinPartitions("gram", "context")
    return dealt.mapInArrow(run, "gram bigint, context bigint, skip int, windows int")


def _counted(contexts: DataFrame, length: int) -> DataFrame:
    """The same for grams with very many contexts: windows are counted by hash, over all tasks."""
    def hashes(batches):
        for batch in batches:
            for name, context, n, data in zip(*(batch.column(k) for k in (0, 1, 2, 4))):
                part = np.frombuffer(data.as_buffer(), dtype=np.uint8)
                at = np.arange(len(part) - length + 1)
                own = span_hash(prefix_hash(part), at, at + length).view(np.int64)
                rows = len(own)
                yield pa.RecordBatch.from_arrays([pa.array(own), *(pa.array([v.as_py()] * rows, pa.int64()) for v in (name, context)), pa.array(at.astype(np.int32)), pa.array([n.as_py()] * rows, pa.int64())], names=["w", "gram", "context", "skip", "n"])

    every = contexts.mapInArrow(hashes, "w bigint, gram bigint, context bigint, skip int, n bigint")
    often = every.groupBy("gram", "w").agg(F.sum("n").alias("k")).where("k > 1").select("gram", "w")
    return every.join(often, ["gram", "w"]).select("gram", "context", "skip", F.lit(1).alias("windows"))


def dedup_bytes(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT_CONTEXTS) -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_removed, n_spans, kept``: bytes in strings of ``length`` that occur twice go.

    Minimisers cut each text into runs of windows with one anchor. An anchor met once cannot repeat; one met always in
    the same context repeats as a whole; the rest, the ends of repeats, are decided exactly in suffix arrays over the
    distinct contexts of their grams. A gram with more than ``hot`` distinct contexts is not gathered: its windows are
    counted by hash instead. Matches never cross texts, strings are judged on the input, and overlaps count.

    A null text is empty; shorter texts than ``length`` stay whole; rows with equal id and text each count as an
    occurrence; a null id is kept as it is; an empty table gives no rows; other columns are not read.
    """
    rows = _named(documents)
    located = stored(_located(rows, length, gram), "suffix-anchors")
    grams = located.groupBy("gram").agg(F.count("*").alias("k"), F.min("context").alias("low"), F.max("context").alias("high")).where("k > 1")
    # Stored first, so that the join can part a gram that most anchors have.
    grams = stored(grams.select("gram", (F.col("low") == F.col("high")).alias("whole")), "suffix-grams")
    repeated = stored(located.join(grams, "gram").select("row", "gram", "context", "at", "windows", "skip", "whole"), "suffix-repeats")
    mixed = repeated.where("NOT whole")
    wanted = mixed.groupBy("gram", "context").agg(F.count("*").alias("n"), F.min(F.struct("row", "at", "windows", "skip")).alias("one"))
    wanted = stored(wanted.select("gram", "context", "n", "one.row", "one.at", "one.windows", "one.skip"), "suffix-contexts")
    contexts = stored(_contexts(rows, wanted, length), "suffix-bytes")
    many = contexts.groupBy("gram").agg(F.count("*").alias("k")).where(F.col("k") > hot).select("gram")
    found = _decided(contexts.join(many, "gram", "left_anti"), length, gram).union(_counted(contexts.join(many, "gram", "left_semi").select("gram", "context", "n", "skip", "data"), length))
    found = stored(found.withColumnRenamed("windows", "run"), "suffix-found")
    ends = mixed.drop("skip").join(found, ["gram", "context"]).select("row", (F.col("at") + F.col("skip")).alias("at"), F.col("run").alias("windows"))
    spans = repeated.where("whole").select("row", "at", "windows").union(ends)
    spans = spans.groupBy("row").agg(F.collect_set(F.struct("at", "windows")).alias("spans"))

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept")}
            for data, spans in zip(batch.column(1), batch.column(2)):
                part = np.frombuffer(data.as_buffer(), dtype=np.uint8)
                depth = np.zeros(len(part) + 1, dtype=np.int32)
                for s in spans.as_py() or []:
                    depth[s["at"]] += 1
                    depth[s["at"] + s["windows"] - 1 + length] -= 1
                gone = np.cumsum(depth[:-1]) > 0
                out["n_bytes"].append(len(part))
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(len(_runs(gone)[0]))
                out["kept"].append(part[~gone].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(out[k], pa.binary() if k == "kept" else pa.int64()) for k in out]], names=["doc_id", *out])

    kind = documents.schema["doc_id"].dataType.simpleString()
    joined = rows.join(spans, "row", "left").select("doc_id", "data", "spans")
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")

