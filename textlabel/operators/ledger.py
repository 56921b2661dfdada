"""Resumable scoring (ML4, ML5, UDF5): answers go to a shared store by the digest of what was asked, and only what has no answer is asked.

The store is a Parquet folder on the cluster's shared file system. Each round takes the questions that the store does not answer (an
anti-join), asks them in tasks of at most about ``chunk_rows`` and appends what came back. A task's answers are in the store as soon as
the task ends (each task's files are moved in by itself), whatever becomes of the job: a lost executor, a failed job or a new session
costs the questions of the tasks under way, no more. Equal questions, under equal keys, are asked once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .inference import batch_infer

KEPT = "digest string, raw string, status string, attempts int, round int"


def answers_in(spark, store: str) -> DataFrame:
    """(digest, raw, status, attempts) of the store: of several rounds' answers the one that is ``ok``, else the last; attempts of all."""
    best = F.max_by(F.struct("raw", "status"), F.struct(F.col("status") == "ok", "round")).alias("a")
    return spark.read.schema(KEPT).parquet(store).groupBy("digest").agg(best, F.sum("attempts").cast("int").alias("attempts")).select("digest", "a.*", "attempts")


def answer_all(prompts: DataFrame, predictor_factory: Callable, store: str, key: str = "doc_id", prompt: str | list[str] = "prompt",
               rounds: int = 3, chunk_rows: int = 2000, **infer_kw) -> DataFrame:
    """(key, raw, status, attempts) of every row of ``prompts``. Called again with the same store it goes on where it was; rows that
    failed are asked again, in each of ``rounds`` rounds. A null input is ``no_prompt`` and never asked."""
    spark = prompts.sparkSession
    columns = [prompt] if isinstance(prompt, str) else list(prompt)
    ensure_checkpoint_dir(spark)
    asked = prompts.select(key, *columns).withColumn("digest", F.md5(F.to_json(F.struct(key, *columns)))).checkpoint(eager=True)
    spark.createDataFrame([], KEPT).write.mode("append").parquet(store)  # from here on the store is there
    for n in range(rounds):
        settled = spark.read.schema(KEPT).parquet(store).filter(F.col("status") != "failed").select("digest").distinct()
        todo = asked.join(settled, "digest", "left_anti").dropDuplicates(["digest"]).checkpoint(eager=True)
        left = todo.count()
        if not left:
            break
        got = batch_infer(todo.repartition(-(-left // chunk_rows), "digest"), predictor_factory, key, prompt, passthrough=["digest"], **infer_kw)
        (got.select("digest", "raw", "status", "attempts", F.lit(n).alias("round")).write.mode("append")
         .option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(store))  # 2: a task's files come in when it ends
    return asked.select(key, "digest").join(answers_in(spark, store), "digest", "left").drop("digest")
