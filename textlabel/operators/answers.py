"""Answer parsing and bookkeeping (JSN3, FLT3, JN5, JN6, AG18)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsonparse import cut_answer, flat_json, parse_ok, strict_json, typed_key
from ..session import ensure_checkpoint_dir


def parse_answers(answers: DataFrame, label_cols: list[str], raw: str = "raw", cut: str = "greedy") -> DataFrame:
    """JSN3: raw answer -> ``parse_ok`` + one numeric column per label (null = unusable), by Python's JSON grammar.

    ``cut='greedy'`` is the first-'{'-to-last-'}' rule, ``cut='split'`` the split/rsplit rule that repairs an unclosed object. The cut
    answers are stored; those that expressions decide stay in the JVM, only the rest is read by Python.
    """
    ensure_checkpoint_dir(answers.sparkSession)
    canonical, rest = flat_json("_cut")
    others = [c for c in answers.columns if c != raw]
    cutout = (answers.withColumn("_cut", cut_answer(F.col(raw), cut)).select(*others, "_cut")
              .withColumn("_json", canonical).withColumn("_rest", rest).checkpoint(eager=True))
    told = cutout.filter("not _rest").select(*others, "_json")
    asked = cutout.filter("_rest").select(*others, strict_json("_cut").alias("_json"))
    return told.unionByName(asked).select(*others, parse_ok("_json").alias("parse_ok"), *[typed_key("_json", k).alias(k) for k in label_cols])


def kept_rows(actual: DataFrame, parsed: DataFrame, key: str = "doc_id") -> DataFrame:
    """FLT3 + JN5: actual rows that have a successful answer (left semi join)."""
    return actual.join(parsed.filter("parse_ok").select(key), key, "left_semi")


def missed_rows(actual: DataFrame, parsed: DataFrame, key: str = "doc_id") -> DataFrame:
    """JN6: actual rows without a successful answer (left anti join)."""
    return actual.join(parsed.filter("parse_ok").select(key), key, "left_anti")


def miss_counts(parsed: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AG18: misses, total and miss rate."""
    return parsed.groupBy(*(by or [])).agg(
        F.count_if(~F.col("parse_ok")).alias("n_missed"),
        F.count(F.lit(1)).alias("n_total"),
        (F.count_if(~F.col("parse_ok")) / F.count(F.lit(1))).alias("miss_rate"))
