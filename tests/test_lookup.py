"""Dictionary lookup by blocks: equal to a plain dictionary, and a hot word makes no hot task."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlabel.operators import features as FE
from textlabel.operators import lookup as LK
from textlabel.operators import vocab as V

VOCAB = [("<unk>", 0), ("<pad>", 1), ("the", 2), ("é", 3), ("x", 4)]
ROWS = [(1, [["the", "x"], [], ["zzz", None, "é"]]), (2, None), (3, []), (4, [None, ["the"]]), (4, [None, ["the"]]), (None, [["x"]]), (5, [["the"] * 5000])]


def test_equals_a_plain_dictionary_on_odd_rows(spark):
    vocab = spark.createDataFrame(VOCAB, "token string, idx long")
    df = spark.createDataFrame(ROWS, "doc_id long, tokens array<array<string>>").withColumns({c: F.lit(1) for c in ("token", "idx", "_block", "_tokens")})
    known = dict(VOCAB)
    want = [(k, [[known.get(t, 0) for t in s or [] if t is not None] for s in text or []]) for k, text in ROWS]
    got = [tuple(r) for r in V.index_tokens(df, vocab).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert V.index_tokens(df.limit(0), vocab).collect() == []
    flat = spark.createDataFrame([(1, ["the", "new"]), (2, None)], "doc_id long, tokens array<string>")
    assert sorted(map(tuple, V.index_tokens(flat, vocab).collect())) == [(1, [[2, 0]]), (2, [])]


@pytest.fixture(scope="module")
def hot(spark):
    """One word in half of all places."""
    rng = random.Random(1)
    rows = [(i, [[w for _ in range(20) for w in ("hot", f"w{rng.randrange(3000)}")]]) for i in range(8192)]
    return spark.createDataFrame(rows, "doc_id long, tokens array<array<string>>").repartition(8)


def test_hot_word_is_one_row_a_block(spark, hot):
    laid = LK.in_blocks(hot)
    pairs = LK.block_words(laid, "tokens")
    blocks = laid.select("_block").distinct().count()
    assert pairs.filter("token = 'hot'").count() == blocks <= 8192 / LK.ROWS + 8
    sizes = Counter(r["p"] for r in pairs.repartition(8, "token").select(F.spark_partition_id().alias("p")).collect())
    assert max(sizes.values()) <= 3 * np.median(list(sizes.values()))
    plan = V.index_tokens(hot, spark.createDataFrame([("hot", 0)], "token string, idx long"))._jdf.queryExecution().toString()
    assert "BroadcastHint" not in plan and "ResolvedHint" not in plan


def test_document_embedding_is_the_mean_of_sentence_means(spark):
    vocab = spark.createDataFrame(VOCAB, "token string, idx long")
    vectors = spark.createDataFrame([(i, [float(i + 1), 1.0, -float(i)]) for i in range(5)], "vec_id long, embedding array<double>")
    df = spark.createDataFrame(ROWS, "doc_id long, tokens array<array<string>>")
    unit = {t: np.array([i + 1, 1, -i]) / np.linalg.norm([i + 1, 1, -i]) for t, i in VOCAB}
    want = []
    for k, text in ROWS:
        means = [np.mean([unit.get(t, unit["<unk>"]) for t in s if t is not None], axis=0) for s in text or [] if s]
        if means:
            want.append((k, *np.mean(means, axis=0).round(9)))
    got = [(r["doc_id"], *np.round(r["embedding"], 9)) for r in FE.doc_embeddings(df, vocab, vectors, 3).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_packed_vectors_are_the_normalised_doubles_at_half_the_width(spark):
    """A vector that goes to a block is 32 bits a component, and comes out as the very doubles that Spark normalises."""
    import pyarrow as pa
    dim = 64
    words = ["<unk>", "<pad>", *[f"word{i}" for i in range(300)]]
    vocab = spark.createDataFrame(list(zip(words, range(len(words)))), "token string, idx long")
    rng = np.random.default_rng(2)
    vectors = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=dim)] if i != 4 else [0.0] * dim) for i in range(0, 90, 2)], "vec_id long, embedding array<float>")
    wv = FE.word_vectors(vocab, vectors, dim)
    packed = FE.packed_vectors(wv, "array<float>")
    assert dict(packed.dtypes) == {"token": "string", "given": "array<float>", "hashed": "array<int>", "norm": "double"}
    assert FE.EMBED_ROWS >= 8 * LK.ROWS
    rows = packed.orderBy("token").toArrow()
    want = wv.orderBy("token").select(FE.l2_normalize(F.col("vector")).alias("v")).collect()
    got = FE.unpacked(rows, dim, np.ones(dim))
    assert (got[:-1] == np.array([r["v"] for r in want])).all() and (got[-1] == 1).all()
    only = rows.filter(pa.compute.is_valid(rows.column("given")))  # no hash vector among them
    assert FE.unpacked(only, dim, np.ones(dim)).shape == (45 + 1, dim)


def test_embeddings_store_less_than_the_text_and_send_an_entry_once_to_a_shelf(spark, monkeypatch):
    """Words that no vector is given for go without one; blocks that lie together share their entries; nothing is rounded."""
    rng = random.Random(3)
    rows = [(i, [[f"word{int(3000 * rng.random() ** 3)}" for _ in range(20)] for _ in range(12)]) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<array<string>>").repartition(4, "doc_id")
    monkeypatch.setattr(LK, "SPARE", 0.25)  # shelves of several blocks although the table is small
    packed = LK.pack(df, "doc_id", "tokens", 256)
    size = packed.blocks.agg(F.sum(F.length("documents") + F.length("numbers") + F.length("words")).alias("n")).first()["n"]
    assert size < 0.5 * sum(len(w) for _, text in rows for s in text for w in s)
    shelf = packed.blocks.select("_block", LK.shelves(packed).alias("s")).groupBy("s").agg(F.count("*").alias("n"), F.min("_block").alias("a"), F.max("_block").alias("b"))
    assert 1 < max(r["n"] for r in shelf.collect()) <= LK.SHELF
    want = Counter(w for _, text in rows for s in text for w in s)
    assert {r["token"]: r["n"] for r in V.token_counts(packed).collect()} == want
    vocab = V.build_vocabulary(packed)
    rng = np.random.default_rng(2)
    vectors = spark.createDataFrame([(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(0, 900, 2)], "vec_id long, embedding array<float>")
    unit = {r["token"]: np.array(r["u"]) for r in FE.word_vectors(vocab, vectors, 8).select("token", FE.l2_normalize(F.col("vector")).alias("u")).collect()}
    got = {r["doc_id"]: r["embedding"] for r in FE.doc_embeddings(packed, vocab, vectors, 8).collect()}
    assert len(got) == 6000 and all(np.allclose(got[i], np.mean([np.mean([unit[w] for w in s], axis=0) for s in text], axis=0), rtol=0, atol=1e-12) for i, text in rows[::50])
    plan = FE.doc_embeddings(packed, vocab, vectors, 8)._jdf.queryExecution().toString()
    assert "md5" not in plan


def test_hash_vectors_made_where_they_are_used_are_the_very_doubles(spark):
    words = ["<unk>", "", "é", "x", "日本", "a" * 90]
    vocab = spark.createDataFrame(list(zip(words, range(len(words)))), "token string, idx long")
    vectors = spark.createDataFrame([(3, [1.0] * 16)], "vec_id long, embedding array<float>")
    want = FE.word_vectors(vocab, vectors, 16).orderBy("idx").select(FE.l2_normalize(F.col("vector")).alias("v")).collect()
    sent = FE.packed_vectors(FE.word_vectors(vocab, vectors, 16, hashed=False), "array<float>").select("token", "given", "norm")
    sent = sent.join(vocab, "token").orderBy("idx").drop("idx").toArrow()
    assert (FE.unpacked(FE.with_hashes(sent, 16, 7), 16, np.zeros(16))[:-1] == np.array([r["v"] for r in want])).all()


def test_packed_blocks_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(LK, "PACKED", 100_000)
    df = spark.createDataFrame([(i, [["long" * 50 + str(i)] * 20]) for i in range(2000)], "doc_id long, tokens array<array<string>>").coalesce(1)
    assert LK.pack(df, "doc_id", "tokens", 2048).blocks.count() > 5
