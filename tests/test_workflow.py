"""A reference-shaped run end to end: essays CSV (Mac Roman, TEXT + five y/n traits) ->
Parquet -> bag-of-words metrics, sequence features, exact split, prompt experiment."""

import csv
import io
import os

from pyspark.sql import functions as F

from textlabel.operators import prompts as PR
from textlabel.operators import sampling as S
from textlabel.operators import sequences as SQ
from stubs import RuleStub
from textlabel.plans import pipelines as PL
from textlabel.sources import corpus as C

TRAITS = C.REFERENCE_LABELS


def _essays_csv(spark, folder):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    buf = io.StringIO()
    w = csv.writer(buf, quoting=csv.QUOTE_MINIMAL, lineterminator="\n")
    w.writerow(["#AUTHID", "TEXT"] + TRAITS)
    for r in docs:
        w.writerow([f"id{r['doc_id']}", r["text"]] + ["y" if (r["doc_id"] >> i) & 1 else "n" for i in range(5)])
    path = os.path.join(folder, "essays.csv")
    with open(path, "wb") as f:
        f.write(buf.getvalue().encode("mac_roman", errors="replace"))
    return path, len(docs)


def test_reference_shaped_workflow(spark, tmpdir_path):
    path, n = _essays_csv(spark, tmpdir_path)
    essays = C.csv_to_parquet(spark, path, os.path.join(tmpdir_path, "essays.parquet"))
    assert essays.count() == n and "TEXT" in essays.columns
    df = essays.withColumnRenamed("TEXT", "text")

    metrics = {(r["metric"], r["trait"]): r["value"] for r in PL.bag_of_words(df, TRAITS, max_iter=50).collect()}
    assert len(metrics) == 1 + 3 * len(TRAITS)
    assert 0.0 <= metrics[("overall_accuracy", "all")] <= 1.0

    vocab, cube = SQ.sequence_features(df)
    shapes = cube.select(F.size("cube").alias("s"), F.size(F.col("cube")[0]).alias("l")).distinct().collect()
    assert len(shapes) == 1 and shapes[0]["s"] == 12
    assert vocab.filter(F.col("idx") < 2).count() == 2

    sizes = S.exact_split(df).groupBy("split").count().collect()
    assert sum(r["count"] for r in sizes) == n

    out = PL.prompt_experiment(df, PR.REFERENCE_TRAITS, TRAITS, lambda: RuleStub(keys=TRAITS), frac=0.2,
                               runs=2, example_count=1, max_attempts=2, wait_min=0, wait_max=0)
    got = {(r["metric"], r["trait"]) for r in out.collect()}
    assert ("overall_accuracy", "all") in got and ("recall", "cOPN") in got


def test_bag_of_words_finds_planted_signal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    planted = docs.select(
        "doc_id",
        F.when(F.col("doc_id") % 2 == 1, F.concat("text", F.lit(" zqxsignal"))).otherwise(F.col("text")).alias("text"),
        F.when(F.col("doc_id") % 2 == 1, "y").otherwise("n").alias("odd"),
        F.when(F.col("doc_id") % 3 == 0, "y").otherwise("n").alias("third"))
    m = {(r["metric"], r["trait"]): r["value"] for r in PL.bag_of_words(planted, ["odd", "third"]).collect()}
    # n = 160 training rows against ~10k unit-variance-scaled terms: the L2 fit spreads weight over
    # many separating rare terms, so the planted term lifts accuracy well above chance, not to 1.0
    assert m[("accuracy", "odd")] >= 0.8
    assert m[("accuracy", "third")] < m[("accuracy", "odd")]


def test_sequence_features_prepare_each_text_once_and_only_the_wanted_cubes(spark):
    """The cube's plan starts from stored tokens; ``only`` changes which rows come, not their cubes."""
    rows = [(i, " ".join(f"w{j % (i + 3)}" for j in range(7 * i + 1)) + ".") for i in range(9)] + [(2, "again w1"), (None, "no key")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    vocab, whole = SQ.sequence_features(df)
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan and "regexp" not in vocab._jdf.queryExecution().optimizedPlan().toString()
    _, some = SQ.sequence_features(df, only=spark.createDataFrame([(2,), (2,), (5,), (77,)], "doc_id long"))
    cubes = lambda df: sorted((r["doc_id"], r["cube"]) for r in df.filter("doc_id in (2, 5)").collect())
    assert cubes(some) == cubes(whole) and some.count() == 3 and whole.count() == len(rows)
