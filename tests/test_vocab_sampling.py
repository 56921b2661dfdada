"""Vocabulary order, index lookup, splits and samples: exact sizes and repeatability."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textlabel.operators import sampling as S
from textlabel.operators import sequences as SQ
from textlabel.operators import vocab as V
from textlabel.operators.ranking import hash_rank, md5_key, sorted_index

DOCS = [
    (1, [["b", "a", "<pad>"], ["c", "a"]]),
    (2, [["a", "<unk>", "b"]]),
    (3, [["d"], []]),
    (4, []),
]


def _tokens(spark, parts=1):
    return spark.createDataFrame(DOCS, "doc_id long, tokens array<array<string>>").repartition(parts)


def _py_vocab():
    c = Counter(t for _, d in DOCS for s in d for t in s)
    for s in ("<unk>", "<pad>"):
        c.pop(s, None)
    order = sorted(c.items(), key=lambda x: (-x[1], x[0]))
    return {"<unk>": 0, "<pad>": 1, **{t: i + 2 for i, (t, _) in enumerate(order)}}


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_vocabulary_order_and_specials(spark, parts):
    vocab = V.build_vocabulary(_tokens(spark, parts))
    got = {r["token"]: r["idx"] for r in vocab.collect()}
    assert got == _py_vocab()


def test_index_tokens_roundtrip_and_unknown(spark):
    vocab = V.build_vocabulary(_tokens(spark))
    table = _py_vocab()
    docs = spark.createDataFrame([(1, [["a", "zz"], [], ["b"]]), (2, [])], "doc_id long, tokens array<array<string>>")
    got = {r["doc_id"]: r["ids"] for r in V.index_tokens(docs, vocab).collect()}
    assert got[1] == [[table["a"], 0], [], [table["b"]]]
    assert got[2] == []


def test_numericalize_pads_front(spark):
    ix = spark.createDataFrame([(1, [[5, 6], [7]]), (2, [[8, 9, 10]])], "doc_id long, ids array<array<int>>")
    got = {r["doc_id"]: r["cube"] for r in SQ.numericalize(ix).collect()}
    assert got[1] == [[1, 5, 6], [1, 1, 7]]
    assert got[2] == [[1, 1, 1], [8, 9, 10]]


def test_encode_fixed_moves_pads_front(spark):
    df = spark.createDataFrame([([7, 1, 8, 9, 10],), ([],)], "ids array<int>")
    front, mask = SQ.encode_fixed(F.col("ids"), max_length=6, cls_id=2, sep_id=3, pad_id=1)
    rows = df.select(front.alias("f"), mask.alias("m")).collect()
    # body = first 4 ids [7, 1, 8, 9]; the inner pad id moves to the front
    assert rows[0]["f"] == [1, 2, 7, 8, 9, 3] and rows[0]["m"] == [0, 1, 1, 1, 1, 1]
    assert rows[1]["f"] == [1, 1, 1, 1, 2, 3] and rows[1]["m"] == [0, 0, 0, 0, 1, 1]


@pytest.mark.parametrize("parts", [1, 3])
def test_ranks_exact_and_partition_independent(spark, parts):
    df = spark.range(0, 500).withColumnRenamed("id", "doc_id").repartition(parts)
    got = hash_rank(df.withColumn("k", md5_key(9, "doc_id")), "k", "doc_id", "r").collect()
    assert sorted(r["r"] for r in got) == list(range(1, 501))
    want = sorted(range(500), key=lambda i: (__import__("hashlib").md5(f"9:{i}".encode()).hexdigest(), i))
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["r"])] == want
    idx = sorted_index(df, [F.col("doc_id").desc()], "i").collect()
    assert {r["doc_id"]: r["i"] for r in idx} == {i: 499 - i for i in range(500)}


@pytest.mark.parametrize("n", [0, 1, 9, 10, 371, 2467])
def test_split_sizes(spark, n):
    df = spark.range(0, n).withColumnRenamed("id", "doc_id")
    for rule in ("halves", "fixed"):
        rows = S.exact_split(df, rule=rule).collect()
        c = Counter(r["split"] for r in rows)
        train = int(0.7 * n)
        val = (n - train) // 2 if rule == "halves" else int(0.15 * n)
        assert (c["train"], c["val"], c["test"]) == (train, val, n - train - val)
        assert len({r["doc_id"] for r in rows}) == n
    tt = Counter(r["split"] for r in S.train_test_split(df).collect())
    assert tt["test"] == math.ceil(0.2 * n) and tt["train"] == n - math.ceil(0.2 * n)


def test_sample_fraction_half_even(spark):
    df = spark.range(0, 10).withColumnRenamed("id", "doc_id")
    assert S.sample_fraction(df, 0.25).count() == round(0.25 * 10)  # 2.5 -> 2
    assert S.sample_fraction(df, 0.35).count() == round(0.35 * 10)
    a = {r[0] for r in S.sample_fraction(df.repartition(3), 0.5).collect()}
    b = {r[0] for r in S.sample_fraction(df, 0.5).collect()}
    assert a == b


def test_hash_split_and_examples_repeatable(spark):
    df = spark.range(0, 300).withColumnRenamed("id", "doc_id")
    s1 = {r["doc_id"]: r["split"] for r in S.hash_split(df).collect()}
    s2 = {r["doc_id"]: r["split"] for r in S.hash_split(df.repartition(5)).collect()}
    assert s1 == s2 and set(s1.values()) == {"train", "val", "test"}
    e1 = [r[0] for r in S.sample_examples(df, 3, seed=4).collect()]
    e2 = [r[0] for r in S.sample_examples(df.repartition(7), 3, seed=4).collect()]
    assert e1 == e2 and len(e1) == 3


def test_batch_positions_drop_last(spark):
    df = spark.range(0, 70).withColumnRenamed("id", "doc_id")
    kept = S.batch_positions(df, 32, drop_last=True).collect()
    assert len(kept) == 64 and max(r["batch"] for r in kept) == 1
    assert len(S.batch_positions(df, 32, drop_last=False).collect()) == 70


def test_ids_round_trip_through_vocabulary(spark):
    toks = _tokens(spark)
    vocab = V.build_vocabulary(toks)
    back = {r["idx"]: r["token"] for r in vocab.collect()}
    ids = {r["doc_id"]: r["ids"] for r in V.index_tokens(toks, vocab).collect()}
    for doc_id, doc in DOCS:
        assert [[back[i] for i in s] for s in ids[doc_id]] == doc


def test_hash_vector_formula_and_partitions(spark):
    import hashlib
    from textlabel.operators.features import hash_vector
    words = spark.createDataFrame([("alpha",), ("beta",), ("é",)], "w string")
    for parts in (1, 3):
        got = {r["w"]: r["v"] for r in words.repartition(parts).select("w", hash_vector(F.col("w"), 4, seed=7).alias("v")).collect()}
        for w, v in got.items():
            want = [-0.25 + 0.5 * int(hashlib.md5(f"7:{w}:{d}".encode()).hexdigest()[:8], 16) / 2 ** 32 for d in range(4)]
            assert v == pytest.approx(want)
