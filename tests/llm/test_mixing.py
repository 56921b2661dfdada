"""Mixing sources: targets and takes against plain Python, permutations, layouts, odd rows."""

import collections
import re
import sys
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from textlabel.llm import mixing  # noqa: E402
from textlabel.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_targets(sizes, weights=(1, 2, 3), cap=3):
    """The excess shared again, source by source, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(cap * sizes[s] for s in full)
        out = {s: cap * sizes[s] if s in full else left * weight[s] / sum(weight[r] for r in rest) for s in names}
        above = {s for s in rest if out[s] > cap * sizes[s]}
        if not above:
            return out
        full |= above


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 3000), st.integers(-2 ** 63, 2 ** 63 - 1), st.integers(0, 5))
def test_permutations(n, key, turn):
    assert sorted(mixing.permuted(np.arange(n), n, key, turn)) == list(range(n))


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 4000), st.integers(1, 64), st.integers(-2 ** 63, 2 ** 63 - 1), st.data())
def test_slots_hold_the_quota(size, block, key, data):
    quota = data.draw(st.integers(1, 3 * size))
    count, last = mixing.slot_count(size, quota, block, key)
    n = -(-size // block)
    slot = np.arange(count)
    taken = mixing.permuted(slot % n, n, key, slot // n)
    lengths = np.where(taken == n - 1, size - (n - 1) * block, block)
    assert 0 < last <= block and lengths[:-1].sum() + min(last, lengths[-1]) == quota


def checked(rows, docs, weights=(1, 2, 3), cap=3):
    """What holds of every result; rows: (id, source, text) as given, docs: the result's rows."""
    sizes = collections.Counter()
    for _, s, t in rows:
        sizes[s] += len(words(t))
    target = plain_targets(sizes, weights, cap)
    assert sorted(((r["doc_id"], r["size"], r["source_size"]) for r in docs), key=repr) == sorted(((i, len(words(t)), sizes[s]) for i, s, t in rows), key=repr)
    assert all(0 <= r["taken"] <= cap * r["size"] for r in docs)
    by = collections.defaultdict(int)
    for r in docs:
        by[r["source_size"], round(r["target"], 6)] += r["taken"]
    expected = collections.defaultdict(int)
    for s, t in target.items():
        expected[sizes[s], round(t, 6)] += min(int(t + 0.5), cap * sizes[s])
    assert {k: v for k, v in by.items()} == expected


def test_query_meets_every_target(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    got = QUERIES["op11_source_mix"](spark, SF).collect()
    checked(rows, got)


ODD = [(i, f"s{i % 4}" if i % 3 else "s0", f"w{i} " * (i % 50)) for i in range(300)]
ODD += [(None, None, "no key or source"), (None, None, "no key or source"), (5, "s1", None), (5, "s1", ""), (5, "s1", "  \t"), (7, "", "empty name"), (8, "é", "x " * 20_000)]
ODD += [(9, "s2", "the same row again")] * 200 + [(1, "tiny", "one")]


@pytest.fixture(scope="module")
def odd(spark):
    clash = ("size", "taken", "target", "s", "start", "block", "words", "digest", "copies")
    return spark.createDataFrame(ODD, "doc_id long, source string, text string").withColumns({c: F.lit("x") for c in clash})


@pytest.mark.parametrize("block", [1, 7, 512])
def test_odd_rows(odd, block):
    checked(ODD, mixing.Mix(odd, block=block, shard_words=500).taken().collect())


def test_takes_equal_a_plain_count_of_drawn_blocks(odd):
    """Streams laid out as the operator says, blocks drawn by its permutation, words counted one by one."""
    mix = mixing.Mix(odd, block=16, shard_words=900)
    keys = {r["s"]: r["key"] for r in mix.sources.select("s", F.xxhash64("s", F.lit(1)).alias("key")).collect()}
    streams, placed = collections.defaultdict(list), sorted(mix.placed.collect(), key=lambda r: (r["s"], r["start"]))
    for r in placed:
        if r["size"]:
            assert r["start"] == len(streams[r["s"]])  # no gap and no overlap
            streams[r["s"]] += [(r["id"], r["digest"], c) for c in range(r["copies"]) for _ in range(r["size"])]
    taken = collections.Counter()
    for r in mix.sources.collect():
        size, quota = r["source_size"], min(int(r["target"] + 0.5), 3 * r["source_size"])
        if quota:
            count, last = mixing.slot_count(size, quota, 16, keys[r["s"]])
            n = -(-size // 16)
            for slot in range(count):
                b = int(mixing.permuted(np.array([slot % n]), n, keys[r["s"]], slot // n)[0])
                part = streams[r["s"]][16 * b:16 * b + 16]
                taken.update((r["s"], *w) for w in (part[:last] if slot == count - 1 else part))
    assert sorted(taken.values()) == sorted(r["taken"] for r in mix.taken().collect() if r["taken"])
    per_shard = mix.spans().groupBy("shard").agg(F.sum("words").alias("n")).collect()
    assert len(per_shard) == mix.shards and sum(r["n"] for r in per_shard) == sum(taken.values())


def test_other_layouts_and_reruns_agree(odd):
    def rows(df):
        return sorted(map(tuple, mixing.Mix(df, block=8, shard_words=700).taken().collect()), key=repr)

    assert rows(odd) == rows(odd.repartition(7, "text")) == rows(odd.coalesce(1).orderBy(F.desc("text")))


def test_mixed_texts_are_words_of_their_documents(odd):
    mix = mixing.Mix(odd, block=8, shard_words=700)
    texts = mix.mixed_texts().collect()
    assert len({(r["shard"], r["place"]) for r in texts}) == len(texts)
    given_words = {w for _, _, t in ODD for w in words(t)}
    found = [w for r in texts for w in r["text"].split(" ")]
    assert all(len(r["text"].split(" ")) <= 8 for r in texts) and set(found) <= given_words
    assert len(found) == sum(r["taken"] for r in mix.taken().collect())


def test_empty_table_and_wrong_parameters(odd):
    assert mixing.Mix(odd.limit(0)).taken().collect() == []
    blank = mixing.Mix(odd.filter("doc_id = 5 and source = 's1' and text is not null and trim(both ' \t' from text) = ''")).taken().collect()
    assert {(r["size"], r["target"], r["taken"]) for r in blank} <= {(0, 0.0, 0)}
    with pytest.raises(ValueError):
        mixing.Mix(odd, block=0)
