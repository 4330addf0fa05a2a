"""Repair of conversation structure: damaged turns are mended by cheapest edits, over a Re-Pair grammar of role and fault sequences.

A conversation is a word of letters, one per row: the role's initial (``s``, ``u``, ``a``, other) and the row's first
fault. A letter is a min-plus matrix over four states of the repaired roles (nothing yet, after system, after user, after
assistant). Frequent pairs of letters become rules; a rule's matrix is the product of its two halves, computed once and
shared by every conversation. An entry keeps its cost, the state between the halves (the rope of its audit) and the place
of its audit among the row's audits, so equal costs are told apart without spelling any audit out: audits that lead from
one state over the same rows never start one another, as each ends with a row's edit.
"""

import hashlib
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from symbolweave.llm.common import stored

SPACES = " \t\n\x0b\x0c\r"
ROLES, FAULTS = "suax", "-bdt"
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP_TO = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEEDED = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
FAR = 1 << 60
SEGMENT, RULES, RULES_A_ROUND = 4096, 1024, 64
_LETTERS, _RULES_FROM = ord("A"), 0x4E00


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)`` after the damage that crc32 of ``conv_id:turn`` modulo 20 names; null roles, texts and ids count as one space."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(code == 1, "").when(code == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    rows = conversations.select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"),
        F.when(code == 3, 2).otherwise(1).alias("copies"), code.alias("code"))
    return rows.where("code <> 0").drop("code")


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys of which null equals null; the right keys go."""
    other = right.withColumnsRenamed({k: f"right_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"right_{k}")) for k in keys]
    return left.join(other, on, how).drop(*(f"right_{k}" for k in keys))


def _facts(rows: DataFrame) -> DataFrame:
    """One row per different row of a conversation, without its text: its place in the order, first fault and copies."""
    solid = F.rtrim(F.col("text"), F.lit(SPACES))
    facts = stored(
        rows.select("conv_id", "turn", "role", F.substring("text", 1, 256).alias("head"), F.md5("text").alias("digest"),
                    (solid == "").alias("blank"), (~F.substring(solid, -1, 1).isin(".", "!", "?")).alias("cut"), "copies")
        .groupBy("conv_id", "turn", "role", "head", "digest", "blank", "cut").agg(F.sum("copies").alias("n")), "turn-facts")
    key = ["conv_id", "role", "digest"]
    seen = facts.groupBy(*key).agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("k")).where("k > 1")
    late = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    fault = F.when(F.col("blank"), "b").when(late, "d").when(F.col("cut"), "t").otherwise("-")
    initial = F.substring("role", 1, 1)
    return _joined(facts, seen, key, "left").select(
        "conv_id", "turn", "role", "head", "digest", "n", fault.alias("fault"), F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"))


def letter(initial: str, fault: str) -> str:
    return chr(_LETTERS + 4 * ROLES.index(initial) + FAULTS.index(fault))


def _segments(batches, schema):
    """Runs of one conversation's rows as words of at most ``SEGMENT`` letters, with the rows that an edit can keep."""
    number, conv, part, word, picks = 0, None, None, [], []

    def flush():
        return {"part": part, "seg": number, "conv_id": conv, "word": "".join(word), "picks": list(picks)}

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if word and (row["conv_id"] != conv or (row["conv_id"] is None) != (conv is None)):
                out.append(flush())
                number, word, picks = number + 1, [], []
            conv, part, left = row["conv_id"], row["part"], row["n"]
            again = letter(row["initial"], "b" if row["fault"] == "b" else "d")
            now = letter(row["initial"], row["fault"])
            while left:
                if len(word) == SEGMENT:
                    out.append(flush())
                    number, word, picks = number + 1, [], []
                if left == row["n"]:
                    if row["fault"] in "-t":
                        picks.append({"at": len(word), "turn": row["turn"], "role": row["role"], "digest": row["digest"]})
                    word.append(now)
                    left -= 1
                else:
                    more = min(left, SEGMENT - len(word))
                    word.append(again * more) if more == 1 else word.extend(again * more)
                    left -= more
            if len(out) >= 256:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    if word:
        yield pa.RecordBatch.from_pylist([flush()], schema=schema)


def _shortened(words: list[str], rules: list[tuple[str, str]]) -> list[str]:
    """The words with every rule applied in turn, side by side in one string."""
    if not words:
        return []
    block = "\n".join(words)
    for i, (a, b) in enumerate(rules):
        block = block.replace(a + b, chr(_RULES_FROM + i))
    return block.split("\n")


def _pairs(batches, rules):
    for batch in batches:
        block = "\n".join(_shortened(batch.column(0).to_pylist(), rules))
        codes = np.frombuffer(block.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        both = (codes[:-1] << 32 | codes[1:])[(codes[:-1] != 10) & (codes[1:] != 10)] if len(codes) > 1 else codes[:0]
        pair, n = np.unique(both, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], names=["pair", "n"])


def learn_rules(words: DataFrame, max_rules: int = RULES) -> list[tuple[str, str]]:
    """Re-Pair rules of ``words(word)``, each the pair of symbols that it stands for.

    Every round counts neighbouring pairs of all distinct words and makes rules of the most frequent ones, as many as can
    be replaced in any order; it ends when no pair occurs twice or at ``max_rules``, which bounds the grammar and not the
    words: symbols without a rule stay as they are.
    """
    words = stored(words.select("word").distinct(), "turn-words")
    rules: list[tuple[str, str]] = []
    while len(rules) < max_rules:
        counted = words.mapInArrow(partial(_pairs, rules=list(rules)), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        best = counted.where("n > 1").orderBy(F.desc("n"), "pair").limit(4 * RULES_A_ROUND).collect()
        firsts, seconds, new = set(), set(), []
        for row in best:
            a, b = row["pair"] >> 32, row["pair"] & 0xFFFFFFFF
            if a in seconds or b in firsts or (a == b and (a in firsts or b in seconds)):
                continue
            firsts.add(a)
            seconds.add(b)
            new.append((chr(a), chr(b)))
        new = new[: min(RULES_A_ROUND, max_rules - len(rules))]
        if not new:
            break
        rules += new
    return rules


def _ways_in(state: int):
    """States that inserts lead to, with their cost and audit."""
    found, cost, audit = {state: (0, "")}, 0, ""
    while True:
        state = NEEDED[state][1]
        if state in found:
            return found
        cost, audit = cost + INSERT, audit + "I"
        found[state] = (cost, audit)


def _edits(state: int, initial: str, fault: str):
    yield state, DELETE, "D"
    if fault in "-t":
        extra = TRUNCATED * (fault == "t")
        if (state, initial) in KEEP_TO:
            yield KEEP_TO[state, initial], extra, "K"
        yield NEEDED[state][1], REROLE + extra, "R"


class Grammar:
    """Transfer matrices of the letters and rules: costs, ranks of audits, and the states between a rule's halves."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.rules = rules
        self.halves = {chr(_RULES_FROM + i): pair for i, pair in enumerate(rules)}
        self.audits, self.cost, self.rank, self.via = {}, {}, {}, {}
        for initial in ROLES:
            for fault in FAULTS:
                self._letter(letter(initial, fault), initial, fault)
        for symbol, (a, b) in self.halves.items():
            self._product(symbol, a, b)
        self.spell = lru_cache(maxsize=4096)(self._spell)

    def __reduce__(self):
        return Grammar, (self.rules,)

    def _letter(self, symbol, initial, fault):
        cost, rank, audits = [[FAR] * 4 for _ in range(4)], [[0] * 4 for _ in range(4)], {}
        for p in range(4):
            best = {}
            for q, (c, audit) in _ways_in(p).items():
                for to, more, edit in _edits(q, initial, fault):
                    best[to] = min(best.get(to, (FAR, "")), (c + more, audit + edit))
            for place, q in enumerate(sorted(best, key=lambda q: best[q][1])):
                cost[p][q], rank[p][q], audits[p, q] = best[q][0], place, best[q][1]
        self.cost[symbol], self.rank[symbol], self.audits[symbol] = cost, rank, audits

    def step(self, costs, ranks, symbol):
        """Costs, ranks and previous states of one row of costs after a symbol."""
        cost, rank = self.cost[symbol], self.rank[symbol]
        new, via, order = [FAR] * 4, [0] * 4, []
        for q in range(4):
            least, _, r = min((costs[r] + cost[r][q], ranks[r], r) for r in range(4))
            if least < FAR:
                new[q], via[q] = least, r
                order.append((ranks[r], rank[r][q], q))
        out = [0] * 4
        for place, (_, _, q) in enumerate(sorted(order)):
            out[q] = place
        return new, out, via

    def _product(self, symbol, a, b):
        rows = [self.step(self.cost[a][p], self.rank[a][p], b) for p in range(4)]
        self.cost[symbol], self.rank[symbol], self.via[symbol] = ([r[k] for r in rows] for k in range(3))

    def _spell(self, symbol, p, q):
        """The audit of an entry: its rope, spelt out."""
        if symbol in self.audits:
            return self.audits[symbol][p, q]
        a, b = self.halves[symbol]
        mid = self.via[symbol][p][q]
        return self._spell(a, p, mid) + self._spell(b, mid, q)

    def solve(self, words: list[str]):
        """Cost, closing inserts, and for each word the state before it and its audit."""
        costs, ranks, trail = [0, FAR, FAR, FAR], [0] * 4, []
        short = _shortened(words, self.rules)
        for word in short:
            for symbol in word:
                costs, ranks, via = self.step(costs, ranks, symbol)
                trail.append(via)
        closing = {START: (0, ""), ASSISTANT: (0, ""), USER: (INSERT, "I"), SYSTEM: (2 * INSERT, "II")}
        cost, _, state = min((costs[q] + closing[q][0], ranks[q], q) for q in range(4))
        tail, out, k = closing[state][1], [], len(trail)
        for word in reversed(short):
            parts = []
            for symbol in reversed(word):
                k -= 1
                before = trail[k][state]
                parts.append(self.spell(symbol, before, state))
                state = before
            out.append((state, "".join(reversed(parts))))
        return cost, tail, out[::-1]


def counts_of(words: list[str]) -> dict:
    """Blank, duplicate and truncated rows of a conversation's words, and neighbours whose initials may not meet."""
    out = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    last = None
    for word in words:
        codes = np.frombuffer(word.encode(), dtype=np.uint8) - _LETTERS
        for name, fault in (("blank", "b"), ("duplicate", "d"), ("truncated", "t")):
            out[name] += int((codes % 4 == FAULTS.index(fault)).sum())
        roles = codes // 4 if last is None else np.concatenate(([last], codes // 4))
        meets = 4 * roles[:-1].astype(int) + roles[1:]
        out["illegal"] += int((~np.isin(meets, [4 * 0 + 1, 4 * 1 + 2, 4 * 2 + 1])).sum())
        last = codes[-1] // 4
    return out


def _audits(batches, grammar, schema):
    """Each conversation's words, in order, solved: one row per word; the last one also carries what holds for all."""
    solve = lru_cache(maxsize=8192)(lambda word: (grammar.solve([word]), counts_of([word])))
    conv, group, out = None, [], []

    def close():
        words = [r["word"] for r in group]
        (cost, tail, parts), counts = solve(words[0]) if len(words) == 1 and len(words[0]) <= 64 else (grammar.solve(words), counts_of(words))
        for r, (state, edits) in zip(group, parts):
            out.append({"part": r["part"], "seg": r["seg"], "conv_id": conv, "state": state, "edits": edits})
        out[-1] |= {"edits": out[-1]["edits"] + tail, "cost": cost, "audit": "".join(e for _, e in parts) + tail, **counts}

    for batch in batches:
        for row in batch.to_pylist():
            if group and (row["conv_id"] != conv or (row["conv_id"] is None) != (conv is None)):
                close()
                group = []
            conv = row["conv_id"]
            group.append(row)
            if len(out) >= 1024:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
    if group:
        close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _mended(batches, schema):
    """Rows of the repaired conversations, in order, still without texts: the edit, the new role and the row it comes from."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            state, at, picks = row["state"], 0, {p["at"]: p for p in row["picks"]}
            for place, edit in enumerate(row["edits"]):
                made = {"conv_id": row["conv_id"], "part": row["part"], "seg": row["seg"], "place": place, "edit": edit}
                if edit == "I":
                    role, state = NEEDED[state]
                    out.append(made | {"new_role": role})
                    continue
                if edit != "D":
                    pick = picks[at]
                    role, to = NEEDED[state]
                    if edit == "K":
                        role, to = pick["role"], KEEP_TO[state, pick["role"][:1]]
                    state = to
                    out.append(made | {"new_role": role, "turn": pick["turn"], "role": pick["role"], "digest": pick["digest"]})
                at += 1
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def _hashed(batches, schema):
    """SHA-256 of each conversation's repaired turns, streamed: nothing but the hash is kept."""
    conv, digest, out = None, None, []
    for batch in batches:
        for c, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "new_role", "text"))):
            if digest is not None and (c != conv or (c is None) != (conv is None)):
                out.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
                digest = None
            conv = c
            if digest is None:
                digest = hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if len(out) >= 1024:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    if digest is not None:
        out.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _map(df: DataFrame, run, fields: list[T.StructField], **more) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType(fields)
    return df.mapInArrow(partial(run, schema=to_arrow_schema(schema), **more), schema)


class Repair:
    """The repair of all conversations: ``audits`` and ``turns`` are tables, ``report`` one row per conversation.

    Rows of a conversation are taken by turn, nulls first; equal turns by role, then by the text's first 256 characters and
    digest, so copies stay together. Equal rows are counted before anything is shuffled, texts travel once, and a
    conversation's rows lie in as many tasks as the range partitions give it; only its letters, its audit and the running
    hash of its repaired turns pass one task. Null ids form one conversation. A conversation whose rows are all dropped
    has zeros, an empty audit and the hash of nothing; an empty table gives no rows; further columns are ignored.
    """

    def __init__(self, conversations: DataFrame):
        self.ids = conversations.select("conv_id").distinct()
        self.rows = damaged(conversations)
        kinds = {f.name: f.dataType for f in conversations.schema.fields}
        field = lambda name, kind: T.StructField(name, kind)
        conv, turn = field("conv_id", kinds["conv_id"]), field("turn", kinds["turn"])
        place = [field("part", T.IntegerType()), field("seg", T.IntegerType()), conv]
        pick = T.StructType([field("at", T.IntegerType()), turn, field("role", T.StringType()), field("digest", T.StringType())])
        order = ["conv_id", "turn", "role", "head", "digest"]
        self.facts = stored(_facts(self.rows), "turn-order")
        sorted_rows = self.facts.repartitionByRange(*order).sortWithinPartitions(*order).drop("head").withColumn("part", F.spark_partition_id())
        segments = stored(_map(sorted_rows, _segments, [*place, field("word", T.StringType()), field("picks", T.ArrayType(pick))]), "turn-segments")
        self.rules = learn_rules(segments)
        grammar = Grammar(self.rules)
        numbers = [field(n, T.LongType()) for n in ("cost", "blank", "duplicate", "truncated", "illegal")]
        words = segments.drop("picks").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg")
        self.audits = stored(_map(words, _audits, [*place, field("state", T.IntegerType()), field("edits", T.StringType()), field("audit", T.StringType()), *numbers], grammar=grammar), "turn-audits")
        solved = segments.drop("conv_id", "word").join(self.audits.select("part", "seg", "conv_id", "state", "edits"), ["part", "seg"])
        self._mended = _map(solved, _mended, [*place, field("place", T.IntegerType()), field("edit", T.StringType()), field("new_role", T.StringType()), turn, field("role", T.StringType()), field("digest", T.StringType())])

    def turns(self) -> DataFrame:
        """``(conv_id, part, seg, place, edit, new_role, turn, text)``: the repaired turns; part, seg and place give their order."""
        mended = stored(self._mended, "turn-edits")
        key = ["conv_id", "turn", "role", "digest"]
        texts = self.rows.select("conv_id", "turn", "role", "text", F.md5("text").alias("digest")).dropDuplicates(key)
        kept = mended.where("digest IS NOT NULL")
        columns = ("conv_id", "part", "seg", "place", "edit", "new_role", "turn")
        with_text = _joined(kept, texts, key, "inner").select(*columns, "text")
        return with_text.union(mended.where("digest IS NULL").select(*columns, F.lit("").alias("text")))

    def report(self) -> DataFrame:
        """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of every original conversation."""
        by_turn = self.facts.select("conv_id", "turn").distinct().groupBy("conv_id")
        spans = by_turn.agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
        hashes = _map(
            self.turns().repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg", "place").select("conv_id", "new_role", "text"),
            _hashed, [T.StructField("conv_id", self.ids.schema["conv_id"].dataType), T.StructField("repaired_sha256", T.StringType())])
        whole = self.audits.where("audit IS NOT NULL").drop("part", "seg", "state", "edits")
        out = self.ids
        for right in (spans, whole, hashes):
            out = _joined(out, right, ["conv_id"], "left")
        number = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        return out.select(
            "conv_id", *number, F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def repair(conversations: DataFrame) -> Repair:
    return Repair(conversations)
