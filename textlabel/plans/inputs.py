"""Inputs derived from the driver tables (the same derivations are written in SQL in
``plans/oracle.py``).

* corpus: ``documents`` (doc_id, text); labelled corpus: inner join ``labels`` on doc_id.
* y/n labels: ``quality``/``toxic`` = 1 -> 'y', else 'n'.
* model scores: logit (n_chars - 1500) / 1000 for quality, its negative for toxic.
* runs: run r in 0..2 predicts with cut-off (4 + r) / 10.
* epoch log: ``events`` — run = user_id, epoch = event_id, val_loss = value,
  val_acc = 1 / (1 + value); for batch means epoch = day, batch = hour.
* word vectors: ``embeddings`` row ``vec_id`` is the vector of vocabulary index ``vec_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import sigmoid, threshold
from ..sources.corpus import read_table

LABELS = ["quality", "toxic"]
TRAITS = [("Quality", "quality"), ("Toxicity", "toxic")]
N_RUNS = 3


def documents(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents", spread=True).select("doc_id", "text", "n_chars")


def _yn(c: str) -> Column:
    return F.when(F.col(c) == 1, "y").otherwise("n").alias(c)


def labelled_yn(spark: SparkSession, d: str) -> DataFrame:
    """The essays-shaped frame: doc_id, text, n_chars, one y/n column per label."""
    lab = read_table(spark, d, "labels").select("doc_id", _yn("quality"), _yn("toxic"))
    return documents(spark, d).join(lab, "doc_id")


def labelled_int(spark: SparkSession, d: str) -> DataFrame:
    lab = read_table(spark, d, "labels").select("doc_id", "quality", "toxic")
    return documents(spark, d).join(lab, "doc_id")


def all_docs_yn(spark: SparkSession, d: str) -> DataFrame:
    """Every document with y/n labels where a label row exists (null otherwise)."""
    lab = read_table(spark, d, "labels").select(
        "doc_id", *[F.when(F.col(c) == 1, "y").when(F.col(c) == 0, "n").alias(c) for c in LABELS])
    return read_table(spark, d, "documents").join(lab, "doc_id", "left")


def logit(trait: str) -> Column:
    base = (F.col("n_chars") - 1500) / F.lit(1000.0)
    return base if trait == "quality" else -base


def scored_cells(spark: SparkSession, d: str) -> DataFrame:
    """One row per (doc, label): actual, logit, score."""
    lab = labelled_int(spark, d)
    cells = lab.select("doc_id", F.explode(F.array(*[
        F.struct(F.lit(t).alias("trait"), F.col(t).cast("double").alias("actual"),
                 logit(t).alias("logit")) for t in LABELS])).alias("c")).select("doc_id", "c.*")
    return cells.withColumn("score", sigmoid(F.col("logit")))


def run_cells(spark: SparkSession, d: str) -> DataFrame:
    """(run, doc_id, trait, actual, predicted) for the three cut-off runs."""
    cells = scored_cells(spark, d).withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(N_RUNS - 1))))
    cut = (F.lit(4) + F.col("run")) / F.lit(10.0)
    return cells.select("run", "doc_id", "trait", "actual",
                        threshold(F.col("score"), cut).cast("double").alias("predicted"))


def epoch_log(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    return ev.select(F.col("user_id").alias("run"), F.col("event_id").alias("epoch"),
                     F.col("value").alias("val_loss"),
                     (F.lit(1.0) / (F.lit(1.0) + F.col("value"))).alias("val_acc"))


def batch_log(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    return ev.select(F.col("user_id").alias("run"),
                     F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).alias("epoch"),
                     F.hour("ts").alias("batch"), F.col("value").alias("loss"))


# contraction probes: the documents contain no apostrophe, so a prefix is added by doc_id
CONTRACTION_PREFIXES = ["I'm sure, ", "She's here. ", "don't ", "CAN'T; it'she's ", "they're we're "]


def with_contraction_prefix(df: DataFrame) -> DataFrame:
    arr = F.array(*[F.lit(p) for p in CONTRACTION_PREFIXES])
    pick = F.element_at(arr, (F.col("doc_id") % len(CONTRACTION_PREFIXES) + 1).cast("int"))
    return df.withColumn("text", F.concat(pick, F.col("text")))


def ruled_answers(prompts: DataFrame, by: tuple = ()) -> DataFrame:
    """(by, doc_id, raw, status, attempts): answers to parse, as a plain rule on the prompt's length and the key. The layout goes by
    doc_id mod 7 (no object, an unclosed one, one in prose, a clean one, a string value, two objects, a boolean and a further key); every
    13th key has no answer."""
    n, key = F.length("prompt"), F.col("doc_id")
    a, b = F.when(n >= 2000, "1").otherwise("0"), F.when(n % 3 == 0, "1").otherwise("0")
    first, second = F.concat(F.lit('"quality": '), a), F.concat(F.lit('"toxic": '), b)
    words = F.concat(F.lit('"quality": '), F.when(a == "1", "true").otherwise("false"))
    layouts = [
        F.lit("I am not able to tell from this essay."),
        F.concat(F.lit("Result: {"), first, F.lit(", "), second),
        F.concat(F.lit("Sure!\n{"), first, F.lit(",\n "), second, F.lit("} ok")),
        F.concat(F.lit("{"), first, F.lit(", "), second, F.lit("}")),
        F.concat(F.lit('{"quality": "'), a, F.lit('", '), second, F.lit("}")),
        F.concat(F.lit("{"), first, F.lit("} and {"), second, F.lit("}")),
        F.concat(F.lit("  {"), words, F.lit(", "), second, F.lit(', "note": "x"}  ')),
    ]
    down = key % 13 == 0
    raw = F.when(n.isNotNull() & ~down, F.element_at(F.array(*layouts), (key % 7 + 1).cast("int")))
    status = F.when(n.isNull(), "no_prompt").when(down, "failed").otherwise("ok")
    attempts = F.when(n.isNull(), 0).when(down, 3).when(key % 11 == 0, 2).otherwise(1)
    return prompts.select(*by, "doc_id", raw.alias("raw"), status.alias("status"), attempts.cast("int").alias("attempts"))
