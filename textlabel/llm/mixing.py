"""Mixing sources to target weights: a stream of words per source, cut into blocks of a fixed length, drawn by index.

1. Sizes: words (runs without blanks) of every document; a source's target is its share by weight of all words, held to ``cap`` times
   its own size, the excess shared again by weight among the others until none is above.
2. Blocks: the documents of a source, ordered by the digest of their texts, follow each other as one stream of words, cut every
   ``block`` words; the last block of a stream is shorter.
3. Draws: the slots that a source fills are dealt to the output shards by a multinomial draw, seeded by the source. Each shard's source
   counts are then multinomial at the target weights, conditioned on the sources' totals, so that a target is met to the word.
4. Indices: slot k of a source is place k mod n of pass k div n over its n blocks; a pseudorandom permutation of 0..n-1 (a Feistel
   network with a key for each source and pass, walked until the value is below n) names the block. So every pass takes each block
   once, nothing is held or shuffled to draw, and no document is taken more often than there are passes. The last slot of the last
   pass takes only the words that are still missing.
5. Join: slots and the documents' parts of blocks meet on (source, block).

Only narrow rows move: (document, source, size, digest), slots and parts; texts are read for their sizes, and by ``mixed_texts`` once
more. A hot source is dealt to buckets for its running sizes and to blocks for the join; equal rows are counted before they move and
interchangeable. Sources are a table like any other, never on the driver.

Null text has no words; a null source is one source, the last; a null key is a key like any other; documents without words are in
the result with taken = 0; a table without words or rows gives zero targets or no rows; other columns are not read. Long texts only
have more parts. Reruns and other layouts give the same rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.ranking import sorted_index
from .common import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
#: words of a block, and of an output shard (about)
BLOCK, SHARD = 512, 1 << 24
ROUNDS = 4
_ORDER = "case when {0} is null then '1' else concat('0', cast({0} as string)) end"  # by code point, null last


def _rows(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """(source key, document, size, digest, copies): equal rows are one row, counted where they are read."""
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    return stored(docs.select(F.expr(_ORDER.format(f"`{source}`")).alias("s"), F.col(key).alias("id"), words.alias("size"),
                              F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest"))
                  .groupBy("s", "id", "size", "digest").agg(F.count(F.lit(1)).alias("copies")))


def source_targets(rows: DataFrame, weights=WEIGHTS, cap: int = 3) -> DataFrame:
    """(s, source_size, weight, target) of every source, in the order of their names; ``rows`` as by ``_rows``."""
    sizes = rows.groupBy("s").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    ranked = sorted_index(sizes, [F.col("s").asc()], "rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = stored(ranked.select("s", "source_size", weight.alias("weight")))
    most = F.col("source_size") * F.lit(cap)
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"]
    level, full = 0.0, -1
    while True:  # the level rises with every source that is full; each round is one small aggregate
        above = F.col("weight") * F.lit(level) > most
        r = sources.agg(F.count_if(above).alias("n"), F.coalesce(F.sum(F.when(above, most)), F.lit(0)).alias("held"),
                        F.sum(F.when(~above, F.col("weight"))).alias("w")).first()
        if r["n"] == full or not r["w"]:
            break
        full, level = r["n"], (total - r["held"]) / r["w"]
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(float(level)), most.cast("double")))


def permuted(index: np.ndarray, n: int, key: int, turn) -> np.ndarray:
    """The images of ``index`` (each in 0..n-1) under the permutation of 0..n-1 that ``key`` and ``turn`` (a number or one for each) name."""
    half = max(1, (max(int(n) - 1, 1).bit_length() + 1) // 2)
    mask, out = np.uint64((1 << half) - 1), index.astype(np.uint64)
    turn = np.broadcast_to(np.asarray(turn, np.uint64), out.shape)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> np.uint64(half), out[walking] & mask
        for i in range(ROUNDS):
            with np.errstate(over="ignore"):
                x = right + np.uint64(key & (2 ** 64 - 1)) + turn[walking] * np.uint64(0x9E3779B97F4A7C15) + np.uint64((i + 1) * 0xD1B54A32D192ED03 & (2 ** 64 - 1))
                x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                x ^= x >> np.uint64(31)
            left, right = right, left ^ (x & mask)
        out[walking] = (left << np.uint64(half)) | right
        walking = walking[out[walking] >= np.uint64(n)]
    return out.astype(np.int64)


def slot_count(size: int, quota: int, block: int, key: int) -> tuple[int, int]:
    """How many slots hold ``quota`` words of a stream of ``size`` words, and the most that the last of them takes of its block."""
    n = -(-size // block)
    passes, rest = divmod(quota, size)
    if not rest:
        return passes * n, block
    slots = -(-rest // block)
    first = permuted(np.arange(slots + 1 if slots < n else slots), n, key, passes)
    words = np.cumsum(np.where(first == n - 1, size - (n - 1) * block, block))
    slots = int(np.searchsorted(words, rest)) + 1
    return passes * n + slots, int(rest - (words[slots - 2] if slots > 1 else 0))


def _dealt(sources: DataFrame, block: int, shards: int, seed: int) -> DataFrame:
    """(s, source_size, key, shard, first, slots, all, last): the run of a source's slots that each shard takes."""
    def run(parts):
        for batch in parts:
            for row in batch.to_pylist():
                if not row["quota"]:
                    continue
                made, last = slot_count(row["source_size"], row["quota"], block, row["key"])
                rng = np.random.Generator(np.random.PCG64(row["key"] & (2 ** 64 - 1)))
                if made < shards:
                    shard, counts = np.unique(rng.integers(0, shards, made), return_counts=True)
                else:
                    counts = rng.multinomial(made, np.full(shards, 1 / shards))
                    shard = np.flatnonzero(counts)
                    counts = counts[shard]
                first = np.cumsum(counts) - counts
                for i in range(0, len(shard), 65536):
                    k = len(shard[i:i + 65536])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["s"]] * k), *[pa.array(np.full(k, v, np.int64)) for v in (row["source_size"], row["key"])],
                         *[pa.array(v[i:i + 65536].astype(np.int64)) for v in (shard, first, counts)],
                         *[pa.array(np.full(k, v, np.int64)) for v in (made, last)]],
                        names=["s", "source_size", "key", "shard", "first", "slots", "all", "last"])

    quota = F.least(F.floor(F.col("target") + 0.5), F.col("most"))
    src = sources.select("s", "source_size", F.xxhash64("s", F.lit(seed)).alias("key"), quota.cast("long").alias("quota"))
    return src.mapInArrow(run, "s string, source_size long, key long, shard long, first long, slots long, all long, last long")


def _slots(dealt: DataFrame, block: int) -> DataFrame:
    """(s, block, shard, slot, words): every slot with the block it takes and how many of its words."""
    def run(parts):
        for batch in parts:
            for row in batch.to_pylist():
                size, n = row["source_size"], -(-row["source_size"] // block)
                for at in range(row["first"], row["first"] + row["slots"], 65536):
                    slot = np.arange(at, min(at + 65536, row["first"] + row["slots"]))
                    turn = slot // n
                    taken = permuted(slot - turn * n, n, row["key"], turn)
                    words = np.where(taken == n - 1, size - (n - 1) * block, block)
                    words[slot == row["all"] - 1] = np.minimum(words[slot == row["all"] - 1], row["last"])
                    yield pa.RecordBatch.from_arrays([pa.array([row["s"]] * len(slot)), pa.array(taken), pa.array(np.full(len(slot), row["shard"], np.int64)),
                                                      pa.array(slot), pa.array(words.astype(np.int64))], names=["s", "block", "shard", "slot", "words"])

    return dealt.repartition("s", "shard").mapInArrow(run, "s string, block long, shard long, slot long, words long")


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``start``, the words of the source's stream before the first copy: sums over buckets, then within them. There are as
    many buckets as a bucket has rows, so that neither sum sees more than about the square root of the table."""
    buckets = max(1, round(rows.count() ** 0.5))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("id", "digest"), F.lit(buckets)))
    words = F.col("size") * F.col("copies")
    totals = dealt.groupBy("s", "bucket").agg(F.sum(words).alias("words"))
    before = totals.select("s", "bucket", (F.sum("words").over(Window.partitionBy("s").orderBy("bucket")) - F.col("words")).alias("before"))
    within = F.sum(words).over(Window.partitionBy("s", "bucket").orderBy("digest", "id", "size"))
    return dealt.withColumn("within", within - words).join(before, ["s", "bucket"]).withColumn("start", F.col("before") + F.col("within")).drop("bucket", "before", "within")


def _parts(placed: DataFrame, block: int) -> DataFrame:
    """(s, block, id, digest, size, start, low, high, first): each copy's part of every block it lies in, ``low`` to ``high`` within the
    block, from word ``first`` of the document."""
    copies = (placed.filter("size > 0").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
              .withColumn("start", F.col("start") + F.col("copy") * F.col("size")))
    end = F.col("start") + F.col("size")
    blocks = copies.withColumn("block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
    left = F.col("block") * block
    low = F.greatest(F.col("start") - left, F.lit(0))
    return blocks.select("s", "block", "id", "digest", "size", "start", low.alias("low"), F.least(end - left, F.lit(block)).alias("high"),
                         (left + low - F.col("start")).alias("first"))


class Mix:
    """A mix of ``docs``, planned once (sizes, targets and streams are stored); its views are tables."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, cap: int = 3,
                 block: int = BLOCK, shard_words: int = SHARD, seed: int = 1):
        if block < 1 or cap < 1 or shard_words < 1 or not weights or min(weights) <= 0:
            raise ValueError("block, cap, shard_words and the weights must be positive")
        self.docs, self.key, self.text, self.block = docs, key, text, block
        self.rows = _rows(docs, key, text, source)
        self.sources = stored(source_targets(self.rows, weights, cap))
        total = self.sources.agg(F.coalesce(F.sum("target"), F.lit(0.0)).alias("n")).first()["n"]
        self.shards = max(1, -(-round(total) // shard_words))
        self.slots = _slots(_dealt(self.sources.withColumn("most", F.col("source_size") * cap), block, self.shards, seed), block)
        self.placed = stored(_placed(self.rows))

    def spans(self) -> DataFrame:
        """(shard, slot, source key, id, digest, size, start, low, first, words): the part of a document that a slot holds. ``low`` is its
        place in the slot; start names the document's place in its stream, which no other document with words has."""
        # sizes are unknown to the planner, which must not send the slots to every executor
        parts = _parts(self.placed, self.block).join(self.slots.hint("merge"), ["s", "block"])
        words = F.least("high", "words") - F.col("low")
        return parts.select("shard", "slot", "s", "id", "digest", "size", "start", "low", "first", words.alias("words")).filter("words > 0")

    def taken(self) -> DataFrame:
        """(key, size, source_size, target, taken) for every document."""
        found = self.spans().groupBy("s", "start", "id", "size").agg(F.sum("words").alias("taken"))
        copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
        every = self.placed.select("s", "id", "size", "start", copy).select(
            "s", "id", "size", F.when(F.col("size") > 0, F.col("start") + F.col("copy") * F.col("size")).alias("start"), F.lit(0).cast("long").alias("taken"))
        # a document with words is named by its place; the others have no place and stay as they are
        whole = (every.filter("start is not null").unionByName(found.select(every.columns)).groupBy("s", "start", "id", "size")
                 .agg(F.sum("taken").alias("taken")).unionByName(every.filter("start is null").select("s", "start", "id", "size", "taken")))
        return whole.join(self.sources, "s").select(F.col("id").alias(self.key), "size", "source_size", "target", "taken")

    def mixed_texts(self) -> DataFrame:
        """(shard, place, text): the mix itself, the words of every slot joined by blanks; ``place`` is a pseudorandom order within a shard."""
        texts = (self.docs.select(F.col(self.key).alias("id"), F.coalesce(F.col(self.text), F.lit("")).alias("text"))
                 .withColumn("digest", F.md5("text")).groupBy("id", "digest").agg(F.first("text").alias("text")))
        spans = self.spans()
        same = spans["id"].eqNullSafe(texts["id"]) & (spans["digest"] == texts["digest"])
        words = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.col("first").cast("int") + 1, F.col("words").cast("int")), " ")
        cut = spans.join(texts.hint("merge"), same).select("shard", "s", "slot", "low", words.alias("text"))
        grouped = cut.groupBy("shard", "s", "slot").agg(F.array_sort(F.collect_list(F.struct("low", "text"))).alias("parts"))
        return grouped.select("shard", F.xxhash64("s", "slot").alias("place"), F.array_join(F.transform("parts", lambda p: p["text"]), " ").alias("text"))
