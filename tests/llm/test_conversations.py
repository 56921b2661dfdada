"""Repair of conversations: against plain dynamic programming over whole edit sequences, split runs, odd rows."""

import hashlib
import random
import re
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from textlabel.llm import conversations as C  # noqa: E402
from textlabel.llm.queries import op12_conversation_repair  # noqa: E402

AFTER = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
NAMES = {"u": "user", "a": "assistant"}


def plain_repair(rows):
    """rows: (initial, cut, gone). The least (cost, edits' initials) with the initials that stay, extended turn by turn; states are the last
    initial ('' at the start)."""
    def with_inserts(best):
        for _ in range(4):
            for q, (cost, audit, out) in list(best.items()):
                for x in "ua":
                    to = AFTER.get((q, x))
                    if to is not None:
                        best[to] = min(best.get(to, (10 ** 9,)), (cost + 3, audit + "I", out + (("I", x),)))
        return best

    best = with_inserts({"": (0, "", ())})
    for initial, cut, gone in rows:
        following = {}
        for q, (cost, audit, out) in best.items():
            some = [(q, 4, "D", (("D", None),))]
            if not gone:
                some += [(AFTER[q, x], 3 + 3 * cut, "R", (("R", x),)) for x in "ua" if (q, x) in AFTER]
                if (q, initial) in AFTER:
                    some.append((AFTER[q, initial], 3 * cut, "K", (("K", initial),)))
            for to, more, letter, kept in some:
                following[to] = min(following.get(to, (10 ** 9,)), (cost + more, audit + letter, out + kept))
        best = with_inserts(following)
    return min(best[q] for q in ("", "a") if q in best)


TURN = st.tuples(st.sampled_from("suax"), st.booleans(), st.sampled_from([False, False, False, True]))


def symbols(rows):
    return np.array([C.GONE if gone else "suax".index(i) + 4 * cut for i, cut, gone in rows], np.int64)


@settings(max_examples=400, deadline=None)
@given(st.lists(TURN, max_size=14))
def test_least_edits(rows):
    turns, audit, cost, tail = C.traced(symbols(rows))
    want = plain_repair(rows)
    assert (cost, audit) == want[:2] and len(turns) == len(rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(TURN, min_size=1, max_size=20), st.lists(st.integers(0, 20), max_size=4))
def test_split_runs_make_the_whole(rows, cuts):
    s = symbols(rows)
    edges = sorted({0, len(s), *[c for c in cuts if c < len(s)]})
    runs = [s[a:b] for a, b in zip(edges, edges[1:])]
    maps, v, behind = [C.segment_map(r) for r in runs], 0, []
    for vectors, _ in reversed(maps):
        behind.append(v)
        v = vectors[v]
    state, audits, costs = 0, "", 0
    for i, (r, (_, states), v) in enumerate(zip(runs, maps, reversed(behind))):
        _, audit, cost, _ = C.traced(r, v, state, i == len(runs) - 1)
        state, audits, costs = states[v][state], audits + audit, costs + cost
    assert (costs, audits) == plain_repair(rows)[:2]


def test_few_vectors_and_a_table_of_all_blocks():
    vectors, table = C.tables()
    assert len(vectors) == len(set(vectors)) < 64 and table.shape == (len(vectors), 10 ** C.BLOCK) and table.max() < len(vectors)


def plainly(rows, damage=True):
    """The contract's columns by conversation from (conv, turn, role, text)."""
    blank, out = re.compile(r"[^\x20\x09-\x0D]"), {}
    groups = defaultdict(list)
    for c, t, role, text in rows:
        groups[c]
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 if damage else 9
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        groups[c] += [(t, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    for c, turns in groups.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults, syms, counts = set(), [], [], dict.fromkeys(C.COUNTS, 0)
        for t, role, text in turns:
            fault = "blank" if not blank.search(text) else "duplicate" if (role, text) in seen else None
            if not fault and text.rstrip(" \t\n\v\f\r")[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            initial = role[:1] if role[:1] in ("s", "u", "a") and role else "x"
            syms.append((initial, fault == "truncated", fault in ("blank", "duplicate")))
            faults.append(role[:1])
        counts["illegal"] = sum(a + b not in ("su", "ua", "au") for a, b in zip(faults, faults[1:]))
        counts["cost"], audit, kept = plain_repair(syms)
        lines, i = [], 0
        for letter, initial in kept:
            if letter == "I":
                lines.append(f"{NAMES[initial]}:")
                continue
            _, role, text = turns[i]
            i += 1
            if letter != "D":
                lines.append(f"{NAMES[initial] if letter == 'R' else role}:{text}")
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        out[c] = (gaps, *[counts[x] for x in C.COUNTS], audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines)
    return out


def some_rows():
    rng = random.Random(5)
    texts = ["Yes.", "No", "", None, "  \n", "Why not?", "é 日本.", "so it goes. \t", "long " * 30_000 + "!"]
    rows = []
    for c in [*range(60), None]:
        for t in rng.sample(range(12), rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice(texts)))
    rows += [(70, None, "user", "Hi."), (70, None, "user", "Hi."), (70, None, "assistant", "Ho."), (70, 3, "user", "Hi.")]
    rows += [(71, t, "user" if t % 2 else "assistant", f"turn {t}{'.' if t % 7 else ''}") for t in range(400)]  # one conversation holds most turns
    rows += [(72, 1, "user", "the same row.")] * 50
    return rows


@pytest.fixture(scope="module")
def table(spark):
    clash = ("c", "t", "r", "d", "n", "part", "kind", "name", "symbol", "_text", "gaps", "audit")
    return spark.createDataFrame(some_rows(), "conv_id long, turn long, role string, text string").withColumns({c: F.lit("x") for c in clash})


@pytest.mark.parametrize("rows", [7, 250_000])
def test_summary_digests_and_turns(table, monkeypatch, rows):
    monkeypatch.setattr(C, "ROWS", rows)  # 7: conversations of 400 turns lie in many partitions
    repair = C.Repair(table)
    want = plainly(some_rows(), damage=False)
    if rows == 7:
        assert repair.ordered.filter("c = 71").select("part").distinct().count() > 20
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.summary().collect()}
    assert got == {c: w[:-2] for c, w in want.items()}
    assert {r["conv_id"]: r["repaired_sha256"] for r in repair.digests().collect()} == {c: w[-2] for c, w in want.items()}
    lines = defaultdict(list)
    for r in sorted(repair.turns().collect(), key=lambda r: r["turn"]):
        assert r["turn"] == len(lines[r["conv_id"]])
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    assert lines == {c: w[-1] for c, w in want.items() if w[-1]}


def test_query_with_damage(spark, table, tmp_path):
    rows = [r for r in some_rows() if r[0] is None or r[0] < 72]
    table.select("conv_id", "turn", "role", "text").filter("conv_id is null or conv_id < 72").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: tuple(r)[1:] for r in op12_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == {c: w[:-1] if w[6] else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, w in plainly(rows).items()}


def test_empty_table(table):
    repair = C.Repair(C.damaged(table.limit(0)))
    assert repair.summary().collect() == [] and repair.digests().collect() == [] and repair.turns().collect() == []
