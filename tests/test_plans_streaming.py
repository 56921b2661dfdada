"""Plan shape checks on the registered queries, the driver contract, and streaming prep."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from textlabel.operators import sequences as SQ
from textlabel.plans import queries as Q
from textlabel.streaming import prepare as ST

SF = "/root/testdata/sf0.001"
#: block lookups and the ledger run Arrow functions; the answers that expressions cannot decide go to Python
PYTHON_QUERIES = {"answer_parse", "answers_kept", "answers_missed", "miss_rate", "batch_infer_model", "bow_logreg", "sequence_scores"}
MODEL_QUERIES = {"bow_pipeline_metrics", "embed_logreg", "random_search"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_contract(spark):
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert {q for q in set(qs) - set(sqls) if q != "pipeline" and not q.startswith("op")} == MODEL_QUERIES
    out = E.entry(spark)
    assert out.columns == ["run", "trait", "precision", "recall"] and out.count() == 6


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - PYTHON_QUERIES - MODEL_QUERIES))
def test_native_queries_have_no_python_udf(spark, name):
    plan = _plan(Q.QUERIES[name](spark, SF))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "MapInPandas" not in plan


def test_index_lookup_broadcasts_checked_vocabulary(spark):
    plan = _plan(Q.token_index(spark, SF))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def _windows(df):
    """(partitioned?, subtree text) for every Window node of the physical plan."""
    out = []

    def walk(p):
        if p.nodeName() == "Window":
            out.append((not p.partitionSpec().isEmpty(), p.child().toString()))
        kids = p.children()
        for i in range(kids.size()):
            walk(kids.apply(i))
    walk(df._jdf.queryExecution().sparkPlan())
    return out


@pytest.mark.parametrize("name", ["split_exact", "sample_fraction", "vocabulary", "best_epoch_trace",
                                  "drop_last_accuracy"])
def test_no_unpartitioned_window_over_rows(spark, name):
    """A window without PARTITION BY runs in one task: allowed only over an aggregated
    (bounded) table such as bucket counts or a value histogram."""
    wins = _windows(Q.QUERIES[name](spark, SF))
    assert wins, name
    for partitioned, subtree in wins:
        assert partitioned or "HashAggregate" in subtree, (name, subtree[:300])


@pytest.mark.parametrize("name", ["length_describe", "length_boxplot"])
def test_quantiles_need_no_window(spark, name):
    assert not _windows(Q.QUERIES[name](spark, SF))


def test_no_action_of_the_fits_returns_more_than_a_row_a_partition(spark, monkeypatch):
    """Dictionary, blocks and passes of the bag-of-words fit: rows and vectors of the vocabulary's length stay on the executors, but for the
    weights, which come as slices."""
    from pyspark.sql.classic.dataframe import DataFrame
    from textlabel.functions import text as TX
    from textlabel.operators import linear as LN
    from textlabel.operators import models as M
    from textlabel.plans import inputs as I
    seen, one = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: (lambda rows: seen.append((len(rows), self.columns)) or rows)(one(self)))
    train = I.labelled_int(spark, SF).select("doc_id", TX.bow_tokens("text").alias("tokens"), *I.LABELS)
    model = M.fit_bag_of_words(train, I.LABELS)
    slices = -(-2 * (model.n_terms + 2) // LN.SLICE)
    assert seen and all(n <= slices and c == ["slice", "sums"] for n, c in seen if n > 1), seen[:5]


def test_streaming_prepare_equals_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    spark.read.parquet(f"{SF}/documents.parquet").write.parquet(src)
    stream = ST.prepared_stream(ST.read_document_stream(spark, src))
    q = stream.writeStream.format("memory").queryName("prep_out").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {r["doc_id"]: r["tokens"] for r in spark.sql("SELECT * FROM prep_out").collect()}
    want = {r["doc_id"]: r["tokens"] for r in SQ.prepare_documents(spark.read.parquet(src)).collect()}
    assert got == want and len(got) == 200


def test_streaming_file_sink(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in2")
    spark.read.parquet(f"{SF}/documents.parquet").write.parquet(src)
    vocab = spark.createDataFrame([("the", 2), ("<pad>", 1)], "token string, idx int")
    ids = ST.indexed_stream(ST.prepared_stream(ST.read_document_stream(spark, src)), vocab)
    out, ck = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ck")
    ST.write_stream(ids, out, ck).awaitTermination()
    assert spark.read.parquet(out).count() == 200


@pytest.mark.parametrize("name", ["token_freq", "run_average_metrics", "best_epoch", "label_value_counts"])
def test_aggregates_combine_map_side(spark, name):
    """Hot keys (a frequent token, a big run) are pre-aggregated before the shuffle."""
    plan = Q.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan, name


def _exchange_columns(df):
    cols = []

    def walk(p):
        if p.nodeName() == "Exchange":
            out = p.output()
            cols.append([out.apply(i).name() for i in range(out.size())])
        kids = p.children()
        for i in range(kids.size()):
            walk(kids.apply(i))
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.initialPlan()  # the physical plan with its exchanges, before AQE re-planning
    walk(plan)
    return cols


def test_exact_split_never_shuffles_text(spark):
    from textlabel.operators import sampling as S
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    for out in (S.exact_split(docs), S.train_test_split(docs), S.sample_fraction(docs, 0.3)):
        exchanged = _exchange_columns(out)
        assert exchanged and all("text" not in c for c in exchanged), exchanged


def test_streaming_ids_equal_batch_lookup(spark, tmpdir_path):
    from textlabel.operators import vocab as V
    src = os.path.join(tmpdir_path, "in3")
    spark.read.parquet(f"{SF}/documents.parquet").write.parquet(src)
    batch = SQ.prepare_documents(spark.read.parquet(src))
    vocab = V.build_vocabulary(batch)
    want = {r["doc_id"]: r["ids"] for r in V.index_tokens(batch, vocab).collect()}
    ids = ST.indexed_stream(ST.prepared_stream(ST.read_document_stream(spark, src)), vocab)
    q = ids.writeStream.format("memory").queryName("ids_out").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {r["doc_id"]: r["ids"] for r in spark.sql("SELECT * FROM ids_out").collect()}
    assert got == want
    out, ck = os.path.join(tmpdir_path, "out3"), os.path.join(tmpdir_path, "ck3")
    ST.write_indexed_stream(ST.prepared_stream(ST.read_document_stream(spark, src)), vocab, out, ck).awaitTermination()
    assert {r["doc_id"]: r["ids"] for r in spark.read.parquet(out).collect()} == want
