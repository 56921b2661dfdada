"""Repair of conversation structure by least edits, with block tables (the method of the Four Russians).

The turns of a conversation, in order, are edited until the initials of their roles read ``(s?(ua)+)?``: Keep costs 0, Rerole to user or
assistant 3, Delete 4 (the only edit of a blank or repeated turn), Insert an empty user or assistant turn 3; a truncated turn that
stays adds 3. Of the cheapest edits those whose initials D, I, K, R are ASCII-least are taken.

A turn is one of nine symbols (initial s, u, a or other, whole or truncated; or to be deleted), so the costs to finish from the four
states of the pattern form a vector that, less its least entry, takes few values. A table holds, for every such vector at the right end
and every block of ``BLOCK`` symbols, the vector at the left end: costs run from right to left a look-up a block. To trace, a block is
expanded backward from its right-hand vector and walked forward, at each step taking the least letter that stays on a cheapest way;
going left to right with costs to the end known, ties cannot mislead the trace.

Distribution: only narrow rows (conversation, turn, role, digest, symbol, copies) are ordered: by range over (conversation, turn,
role, digest), so that a conversation of any length is split over partitions of at most about ``ROWS`` rows. A partition tells what
its first and last conversation make of every vector and state (a few hundred bytes each, two a partition); the driver runs through
these boundaries, and each partition then traces its rows alone. Repeated turns are found by grouping, equal rows are counted before
they move. Texts move once, to be written in order: the one step that is sequential within a conversation, and it streams.

Turns follow each other by turn (null first), then, within equal turns, by role and md5 of the text; equal rows are adjacent. Null roles
and texts are one space. A role with no or another initial cannot be kept. Empty and very long texts, null conversations (one
conversation), empty tables and further columns with any names are allowed; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

BLOCK = 4
#: rows of a partition, about
ROWS = 250_000
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
GONE, PAD = 8, 9  # symbols; 0 to 3 are the initials s, u, a, other, 4 to 7 the same truncated
ROLES = {2: "user", 3: "assistant"}  # the role that leads to a state
# states: nothing yet, after s, after u, after a; KEPT[q][initial] is the state after an initial, NEXT[q] that after the role that fits
KEPT = ((1, 2, None, None), (None, 2, None, None), (None, None, 3, None), (None, 2, None, None))
NEXT = (2, 2, 3, 2)
SPACE = r"\x20\x09-\x0D"


def _closed(costs: list[float]) -> tuple:
    for _ in range(3):
        costs = [min(c, INSERT + costs[NEXT[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


def _step(after: tuple, symbol: int) -> tuple:
    """Costs to the end before a turn, given those after it."""
    if symbol == PAD:
        return after
    costs = [DELETE + c for c in after]
    if symbol != GONE:
        stays = TRUNCATED * (symbol // 4)
        for q in range(4):
            kept = KEPT[q][symbol % 4]
            costs[q] = min(costs[q], stays + REROLE + after[NEXT[q]], *([stays + after[kept]] if kept is not None else []))
    return _closed(costs)


def _normal(costs: tuple) -> tuple:
    return tuple(c - min(costs) for c in costs)


@lru_cache(1)
def tables() -> tuple[list[tuple], np.ndarray]:
    """The normalised vectors, that of the end first, and the vector before each block: table[vector, block code]."""
    vectors = [_normal(_closed([0, float("inf"), float("inf"), 0]))]
    known, one = {vectors[0]: 0}, []
    for v in vectors:  # grows while it is read
        row = []
        for symbol in range(10):
            before = _normal(_step(v, symbol))
            if before not in known:
                known[before] = len(vectors)
                vectors.append(before)
            row.append(known[before])
        one.append(row)
    single, table = np.array(one, np.int16), np.arange(len(vectors), dtype=np.int16)[:, None]
    for _ in range(BLOCK):
        table = np.moveaxis(single[table], 2, 1).reshape(len(vectors), -1)
    return vectors, table


@lru_cache(1 << 17)
def expanded(code: int, right: int, state: int) -> tuple[tuple, int, int]:
    """A block's cheapest, ASCII-least edits from ``state`` with the vector ``right`` behind it: for each turn (letters, states of the
    inserted turns, letter of the turn, state after it); the state after the block; the cost."""
    symbols = [code // 10 ** i % 10 for i in reversed(range(BLOCK))]
    costs = [tables()[0][right]]
    for symbol in reversed(symbols):
        costs.append(_step(costs[-1], symbol))
    costs.reverse()
    turns, spent = [], costs[0][state]
    for i, symbol in enumerate(symbols):
        if symbol == PAD:
            break
        before, after, inserted = costs[i], costs[i + 1], []
        stays = TRUNCATED * (symbol // 4)
        while True:
            kept = KEPT[state][symbol % 4] if symbol != GONE else None
            if before[state] == DELETE + after[state]:
                letter = "D"
            elif before[state] == INSERT + before[NEXT[state]]:
                state = NEXT[state]
                inserted.append(state)
                continue
            elif kept is not None and before[state] == stays + after[kept]:
                letter, state = "K", kept
            else:
                letter, state = "R", NEXT[state]
            turns.append(("I" * len(inserted) + letter, tuple(inserted), letter, state))
            break
    return tuple(turns), state, int(spent - costs[-1][state])


def _codes(symbols: np.ndarray) -> np.ndarray:
    padded = np.full(-(-len(symbols) // BLOCK) * BLOCK, PAD, np.int64)
    padded[:len(symbols)] = symbols
    return padded.reshape(-1, BLOCK) @ (10 ** np.arange(BLOCK - 1, -1, -1))


def segment_map(symbols: np.ndarray) -> tuple[list, list]:
    """What a run of turns does: the vector before it for every vector behind it; the state after it for every such vector and state."""
    vectors, table = tables()
    behind, codes = [], _codes(symbols)
    now = np.arange(len(vectors))
    for code in codes[::-1]:
        behind.append(now)
        now = table[now, code]
    state = np.tile(np.arange(4), (len(vectors), 1))
    for code, right in zip(codes, reversed(behind)):
        some, which = np.unique(right, return_inverse=True)
        after = np.array([[expanded(int(code), int(v), q)[1] for q in range(4)] for v in some])
        state = after[which[:, None], state]
    return now.tolist(), state.tolist()


def traced(symbols: np.ndarray, right: int = 0, state: int = 0, ends: bool = True) -> tuple[list, str, int, list]:
    """A run of turns between a state and a vector: (letters, inserted, letter, state) of each turn, the audit, the cost, and the states of
    the turns inserted behind the last one if the conversation ``ends`` there."""
    table, codes, behind = tables()[1], _codes(symbols), []
    for code in codes[::-1]:
        behind.append(right)
        right = int(table[right, code])
    turns, cost, tail = [], 0, []
    for code, v in zip(codes, reversed(behind)):
        some, state, spent = expanded(int(code), v, state)
        turns += some
        cost += spent
    while ends and state in (1, 2):
        state = NEXT[state]
        tail.append(state)
    return turns, "".join(t[0] for t in turns) + "I" * len(tail), cost + INSERT * len(tail), tail


# ---- the rows -------------------------------------------------------------------------------

ROW = ["c", "t", "r", "d"]
COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def _named(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(c, t, r, d, text): roles and texts without nulls, the digest of the text."""
    named = turns.select(F.col(conv).alias("c"), F.col(turn).alias("t"), F.coalesce(F.col(role), F.lit(" ")).alias("r"), F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    return named.withColumn("d", F.md5("text"))


def _symbols(named: DataFrame) -> DataFrame:
    """Distinct (c, t, r, d) with their copies, and the symbol and faults of the first copy."""
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    open_end = ~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")
    rows = named.select(*ROW, blank.alias("blank"), open_end.alias("open")).groupBy(*ROW, "blank", "open").agg(F.count(F.lit(1)).alias("n"))
    rows = stored(rows)
    firsts = rows.groupBy("c", "r", "d").agg(F.min(F.struct("t")).alias("first")).select(F.col("c").alias("c1"), F.col("r").alias("r1"), F.col("d").alias("d1"), "first")
    seen = rows.join(firsts, F.col("c").eqNullSafe(F.col("c1")) & (F.col("r") == F.col("r1")) & (F.col("d") == F.col("d1"))).drop("c1", "r1", "d1")
    again = ~F.col("t").eqNullSafe(F.col("first")["t"])
    initial = F.coalesce(F.nullif(F.instr(F.lit("sua"), F.substring("r", 1, 1)) * F.length(F.substring("r", 1, 1)), F.lit(0)) - 1, F.lit(3))
    symbol = F.when(F.col("blank") | again, GONE).otherwise(initial + F.when(F.col("open"), 4).otherwise(0))
    return seen.select(*ROW, "n", "blank", initial.cast("int").alias("initial"), symbol.cast("int").alias("symbol"))


def _ordered(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    rows = stored(rows)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS))
    return stored(rows.repartitionByRange(parts, *ROW).sortWithinPartitions(*ROW).withColumn("part", F.spark_partition_id()).withColumn("name", F.col("c").cast("string")))


def _conversations(batches):
    """Tables of whole runs of one conversation, from sorted batches: (table, starts of the runs in it, first of the partition, last)."""
    held, first = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        names = held.column("name").to_pylist()
        starts = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]]]
        if len(starts) > 1:
            yield held.slice(0, starts[-1]).combine_chunks(), starts[:-1], first, False
            held, first = held.slice(starts[-1]), False
    if held is not None:
        yield held.combine_chunks(), [0], first, True


def _run(table: pa.Table, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of a run, copies included, and where the first copies are."""
    part = table.slice(start, end - start)
    n = part.column("n").to_numpy()
    at = np.cumsum(n) - n
    symbols = np.full(int(n.sum()), GONE)
    symbols[at] = part.column("symbol").to_numpy()
    return symbols, at


def _borders(ordered: DataFrame) -> dict:
    """For the first and the last run of every partition: (vector behind, state before, initial before, whether the conversation ends)."""
    def run(batches):
        out = []
        for table, starts, first, last in _conversations(batches):
            for k, (start, end) in enumerate(zip(starts, [*starts[1:], table.num_rows])):
                if (first and k == 0) or last:
                    vectors, states = segment_map(_run(table, start, end)[0])
                    initial = table.column("initial")
                    out.append({"part": table.column("part")[0].as_py(), "first": first and k == 0, "last": last, "name": table.column("name")[start].as_py(),
                                "begins": initial[start].as_py(), "ends": initial[end - 1].as_py(), "vectors": vectors, "states": states})
        yield pa.RecordBatch.from_pylist(out, schema=kinds)

    kinds = pa.schema([("part", pa.int32()), ("first", pa.bool_()), ("last", pa.bool_()), ("name", pa.string()), ("begins", pa.int32()), ("ends", pa.int32()),
                       ("vectors", pa.list_(pa.int32())), ("states", pa.list_(pa.list_(pa.int32())))])
    runs = ordered.mapInArrow(run, "part int, first boolean, last boolean, name string, begins int, ends int, vectors array<int>, states array<array<int>>").collect()
    runs.sort(key=lambda r: (r["part"], not r["first"]))  # two rows a partition at most
    found, chain = {}, []

    def settle():
        behind, v = [], 0
        for r in reversed(chain):
            behind.append(v)
            v = r["vectors"][v]
        state, before = 0, None
        for i, (r, v) in enumerate(zip(chain, reversed(behind))):
            for side in ("first", "last"):
                if r[side]:
                    found[r["part"], side] = (v, state, before, i == len(chain) - 1)
            state, before = r["states"][v][state], r["ends"]

    for r in runs:
        if chain and not (r["first"] and chain[-1]["last"] and r["name"] == chain[-1]["name"]):
            settle()
            chain = []
        chain.append(r)
    settle()
    return found


LEGAL = {(0, 1), (1, 2), (2, 1)}


def _edited(ordered: DataFrame, borders: dict) -> DataFrame:
    """Three kinds of rows: 0, a turn that stays (c, t, r, d), with the roles inserted before it and its new role, null for its own;
    2, the last turn of a conversation, with the roles inserted behind it; 9, the counts and the audit of a run."""
    fields = [*[ordered.schema[x] for x in ROW], T.StructField("kind", T.IntegerType()), T.StructField("lead", T.ArrayType(T.StringType())), T.StructField("role", T.StringType()),
              T.StructField("part", T.IntegerType()), *[T.StructField(x, T.LongType()) for x in COUNTS], T.StructField("audit", T.StringType())]
    names = [f.name for f in fields]

    def run(batches):
        for table, starts, first, last in _conversations(batches):
            at, kind, lead, role = [], [], [], []
            summary = {x: [] for x in ("at", *COUNTS, "audit")}
            part = table.column("part")[0].as_py()
            initial, copies, blank = (table.column(x).to_numpy() for x in ("initial", "n", "blank"))
            symbol = table.column("symbol").to_numpy()
            for k, (start, end) in enumerate(zip(starts, [*starts[1:], table.num_rows])):
                side = "first" if first and k == 0 else "last" if last else None
                right, state, before, ends = borders[part, side] if side else (0, 0, None, True)
                symbols, places = _run(table, start, end)
                turns, audit, cost, tail = traced(symbols, right, state, ends)
                for row, place in zip(range(start, end), places.tolist()):
                    _, inserted, letter, after = turns[place]
                    if letter != "D":  # nothing is inserted before a turn that goes: D and then I is the lesser way
                        at.append(row)
                        kind.append(0)
                        lead.append([ROLES[q] for q in inserted])
                        role.append(ROLES[after] if letter == "R" else None)
                if tail:
                    at.append(end - 1)
                    kind.append(2)
                    lead.append([ROLES[q] for q in tail])
                    role.append(None)
                n, b = copies[start:end], blank[start:end]
                gone = symbol[start:end] == GONE
                around = [before, *initial[start:end].tolist()]
                bad = sum((x, y) not in LEGAL for x, y in zip(around[0 if before is not None else 1:], around[1 if before is not None else 2:]))
                for x, value in zip(summary, (start, n[b].sum(), (n[~b] - 1).sum() + (gone & ~b).sum(), ((symbol[start:end] // 4 == 1)).sum(), bad + (n - 1).sum(), cost, audit)):
                    summary[x].append(value if x == "audit" else int(value))
            for some, columns in ((at, {"kind": kind, "lead": lead, "role": role}), (summary.pop("at"), {"kind": [9] * len(starts), "part": [part] * len(starts), **summary})):
                taken = table.take(pa.array(some, pa.int64())).combine_chunks()
                yield pa.RecordBatch.from_arrays([*[taken.column(x).combine_chunks() for x in ROW], *[pa.array(columns[f.name], arrow[f.name]) if f.name in columns else
                                                  pa.nulls(len(some), arrow[f.name]) for f in fields[4:]]], names=names)

    arrow = {"kind": pa.int32(), "lead": pa.list_(pa.string()), "role": pa.string(), "part": pa.int32(), "audit": pa.string(), **{x: pa.int64() for x in COUNTS}}
    return ordered.mapInArrow(run, T.StructType(fields))


class Repair:
    """The repair of a table of turns: planned once, with views for the summary, the repaired turns and their digests."""

    def __init__(self, turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
        self.conv = conv
        self.named = _named(turns, conv, turn, role, text)
        ordered = _ordered(_symbols(self.named))
        self.ordered = ordered
        self.edited = stored(_edited(ordered, _borders(ordered)))

    def summary(self) -> DataFrame:
        """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation with turns."""
        gaps = self.ordered.groupBy("c", "t").agg(F.lit(1)).groupBy("c").agg((F.max("t") - F.min("t") + 1 - F.count("t")).cast("long").alias("gaps"))
        runs = self.edited.filter("kind = 9").withColumn("gaps", F.lit(None).cast("long"))
        both = runs.select("c", "gaps", *COUNTS, "part", "audit").unionByName(gaps, allowMissingColumns=True)
        audits = F.array_sort(F.collect_list(F.when(F.col("audit").isNotNull(), F.struct("part", "audit"))))
        return (both.groupBy("c").agg(F.coalesce(F.max("gaps"), F.lit(0)).alias("gaps"), *[F.sum(x).alias(x) for x in COUNTS], audits.alias("audits"))
                .select(F.col("c").alias(self.conv), "gaps", *COUNTS, F.array_join(F.transform("audits", lambda a: a["audit"]), "").alias("audit")))

    def _written(self, write, schema) -> DataFrame:
        """Edits and texts side by side in the order of turns, a conversation in one stream; ``write(name, c)`` makes the writer of each."""
        texts = self.named.select(*ROW, F.lit(1).alias("kind"), "text")
        edits = self.edited.filter("kind < 9").select(*ROW, "kind", "lead", "role")
        both = texts.unionByName(edits, allowMissingColumns=True).withColumn("name", F.col("c").cast("string"))
        laid = both.repartition("c").sortWithinPartitions(*ROW, "kind")

        def run(batches):
            writer, now, waiting = None, object(), None
            for batch in batches:
                out = []
                for c, t, r, d, kind, text, lead, role, name in zip(*(batch.column(x).to_pylist() for x in ("c", "t", "r", "d", "kind", "text", "lead", "role", "name"))):
                    if name != now:
                        out += writer.end() if writer else []
                        writer, now, waiting = write(c), name, None
                    if kind == 1:
                        if waiting and waiting[0] == (t, r, d):
                            out += writer.add(r if waiting[1] is None else waiting[1], text)
                        waiting = None
                        continue
                    for x in lead:
                        out += writer.add(x, "")
                    if kind == 0:
                        waiting = ((t, r, d), role)
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=kinds)
            if writer and (out := writer.end()):
                yield pa.RecordBatch.from_pylist(out, schema=kinds)

        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        return laid.mapInArrow(run, schema)

    def turns(self) -> DataFrame:
        """(conv, turn, role, text): the repaired turns, numbered from 0."""
        conv = self.conv

        class Rows:
            def __init__(self, c):
                self.c, self.count = c, itertools.count()

            def add(self, role, text):
                return [{conv: self.c, "turn": next(self.count), "role": role, "text": text}]

            def end(self):
                return []

        return self._written(Rows, T.StructType([T.StructField(conv, self.named.schema["c"].dataType), *[
            T.StructField(n, k) for n, k in (("turn", T.LongType()), ("role", T.StringType()), ("text", T.StringType()))]]))

    def digests(self) -> DataFrame:
        """(conv, repaired_sha256) over ``role:text`` of the repaired turns, joined by newlines; text by text, never a whole conversation."""
        conv = self.conv

        class Digest:
            def __init__(self, c):
                self.c, self.sha, self.any = c, hashlib.sha256(), False

            def add(self, role, text):
                self.sha.update(f"{chr(10) * self.any}{role}:{text}".encode())
                self.any = True
                return []

            def end(self):
                return [{conv: self.c, "repaired_sha256": self.sha.hexdigest()}]

        return self._written(Digest, T.StructType([T.StructField(conv, self.named.schema["c"].dataType), T.StructField("repaired_sha256", T.StringType())]))


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The turns with one in four damaged, by crc32 of ``conv:turn`` modulo 20: 0 drops a turn, 1 empties it, 2 takes its end marks, 3 repeats it,
    4 makes it the user's. Nulls of any column are written as one space (a null turn stays null in its own column)."""
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))) % 20
    rows = turns.select(F.col(conv), F.col(turn), kind.alias("_kind"), F.coalesce(F.col(role), space).alias("_role"), F.coalesce(F.col(text), space).alias("_text"))
    rows = rows.filter("_kind <> 0").withColumn("_copy", F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return rows.select(F.col(conv), F.col(turn), F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("_role")).alias(role),
                       F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.regexp_replace("_text", "[.!?]", "")).otherwise(F.col("_text")).alias(text))
