"""Conversation repair against a plain shortest-path search over whole audits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

pytest.importorskip("symbolweave.llm")

from symbolweave.llm import turn_repair  # noqa: E402
from symbolweave.llm.turn_repair import Grammar, letter  # noqa: E402

SOLID = re.compile(r"[^\x20\x09-\x0D]")
FINAL = re.compile(r"(s?(ua)+)?\Z")
MAY_START = re.compile(r"(s?(ua)*u?)?\Z")


def cheapest(rows):
    """(cost, audit, repaired) of rows ``(role, text, fault)`` by best-first search over (cost, audit)."""
    heap = [(0, "", 0, "", ())]
    while heap:
        cost, audit, i, roles, out = heapq.heappop(heap)
        if i == len(rows) and FINAL.match(roles):
            return cost, audit, out
        nexts = []
        if len(audit) - i < len(rows) + 2:
            nexts += [(cost + 2, audit + "I", i, roles + r[0], out + (r + ":",)) for r in ("user", "assistant")]
        if i < len(rows):
            role, text, fault = rows[i]
            nexts.append((cost + 3, audit + "D", i + 1, roles, out))
            if fault in "-t":
                extra = fault == "t"
                nexts.append((cost + extra, audit + "K", i + 1, roles + (role[:1] or "?"), out + (f"{role}:{text}",)))
                nexts += [(cost + 2 + extra, audit + "R", i + 1, roles + r[0], out + (f"{r}:{text}",)) for r in ("user", "assistant")]
        for n in nexts:
            if MAY_START.match(n[3]):
                heapq.heappush(heap, n)


def expected(table):
    """Report rows of ``(conv_id, turn, role, text)`` by the plain rules."""
    out, groups = {}, {}
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        group = groups.setdefault(conv, [])
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code:
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            group += [(turn, "user" if code == 4 else role, text)] * (1 + (code == 3))
    for conv, group in groups.items():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:256].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        seen, rows = set(), []
        for _, role, text in group:
            solid = SOLID.findall(text)
            rows.append((role, text, "b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "-"))
            seen.add((role, text))
        turns = [t for t, _, _ in group if t is not None]
        cost, audit, lines = cheapest(rows)
        count = lambda f: sum(r[2] == f for r in rows)  # noqa: E731, B023
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count("b"), count("d"), count("t"), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def report(spark, table):
    df = spark.createDataFrame(table, "conv_id bigint, turn bigint, role string, text string, part string, word string")
    rows = turn_repair.repair(df).report().collect()
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(got) == len(rows)
    return got


def conversations(seed, n, turns):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        for t in range(rng.randrange(1, turns)):
            out.append((c, rng.choice((t, t, t, t + 1, None)), rng.choice(("user", "assistant", "user", "assistant", "system", "tool", "", None)),
                        rng.choice(("Yes.", "No", " ", "", None, "Wait!\n", "öö?", f"{t}.", "x" * 900 + "."))))
    return out


def test_report_equals_plain_search(spark):
    table = conversations(1, 60, 7)
    table += [(900, None, "user", "a."), (900, None, "assistant", "b."), (None, 1, "user", "hi."), (None, 2, "assistant", "there"), (901, 0, "system", "only.")]
    table += [(902, 1, "user", "same.")] * 5 + [(c, 3, "user", "a.") for c in range(1000, 1060)]
    wide = [(*r, "p", "w") for r in table]
    got = report(spark, wide)
    assert got == expected(table)
    assert any(g[6] == "" and g[5] == 0 for g in got.values())
    assert report(spark, wide[:0]) == {}


def test_split_conversations_equal_whole_ones(spark, monkeypatch):
    """Segments of three letters, several partitions of one conversation, and a grammar of four rules give the same rows."""
    table = conversations(2, 3, 9) + [(77, t, ("user", "assistant")[t % 2], ("Yes.", "No", "Well.")[t % 3]) for t in range(14)]
    want = expected(table)
    monkeypatch.setattr(turn_repair, "SEGMENT", 3)
    monkeypatch.setattr(turn_repair.learn_rules, "__defaults__", (4,))
    assert report(spark, [(*r, "p", "w") for r in table]) == want


def test_grammar_equals_letter_by_letter():
    rng = random.Random(3)
    letters = [letter(r, f) for r in turn_repair.ROLES for f in turn_repair.FAULTS]
    for _ in range(60):
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 30)))
        rules, short = [], word
        while len(short) > 1:
            rules.append((short[0], short[1]))
            short = short.replace(short[:2], chr(0x4E00 + len(rules) - 1))
        assert Grammar(rules).solve([word]) == Grammar([]).solve([word])


def test_turns_of_a_long_conversation(spark):
    rows = [(5, t, ("user", "assistant")[t % 2], f"line {t}.", "p", "w") for t in range(9000)]
    made = turn_repair.repair(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, part string, word string"))
    turns = made.turns().orderBy("part", "seg", "place").collect()
    assert [r.new_role for r in turns] == ["user", "assistant"] * (len(turns) // 2)
    audit = made.report().first().audit
    assert len(turns) == sum(e != "D" for e in audit) and made.rules
