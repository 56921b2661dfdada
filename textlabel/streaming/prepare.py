"""Streaming text preparation.

The reference has no streaming; every per-row operator here (cleaning, forced sentences,
padding, tokenising, label encoding, prompt text) is a stateless column expression, so it
runs unchanged on a streaming DataFrame. Vocabulary-dependent steps need a fixed
vocabulary table, which a stream-static join supplies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sequences import prepare_documents
from ..operators.vocab import index_tokens

DOCUMENT_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


def read_document_stream(spark: SparkSession, folder: str, schema: T.StructType = DOCUMENT_SCHEMA,
                         max_files_per_trigger: int = 100) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(folder))


def prepared_stream(stream: DataFrame, n_sentences: int = 12, max_words: int = 20) -> DataFrame:
    """Documents -> padded sentences and tokens, per micro-batch, no state."""
    return prepare_documents(stream, n_sentences=n_sentences, max_words=max_words)


def indexed_stream(prepared: DataFrame, vocab: DataFrame, unk_idx: int = 0,
                   max_vocab_rows: int = 2_000_000) -> DataFrame:
    """Token ids through a small fixed vocabulary, as a stream-static map lookup per row; ``write_indexed_stream`` takes any size.

    The vocabulary becomes one broadcast map row, so its size is checked first; unknown
    tokens map to ``unk_idx``.
    """
    n = vocab.count()
    if n > max_vocab_rows:
        raise ValueError(f"vocabulary of {n} rows is too large to broadcast into a stream")
    vmap = vocab.agg(F.map_from_entries(F.collect_list(F.struct("token", "idx"))).alias("_vocab"))
    return prepared.crossJoin(F.broadcast(vmap)).select(
        "doc_id", F.transform("tokens", lambda s: F.transform(
            s, lambda t: F.coalesce(F.element_at(F.col("_vocab"), t), F.lit(unk_idx)).cast("int"))).alias("ids"))


def write_indexed_stream(prepared: DataFrame, vocab: DataFrame, path: str, checkpoint: str, key: str = "doc_id", unk_idx: int = 0, trigger_once: bool = True):
    """Token ids through a vocabulary of any size: each micro-batch is looked up by blocks of documents (``operators.lookup``) and written
    under its batch number, so that a batch that is run again replaces itself."""
    def write(batch: DataFrame, number: int) -> None:
        index_tokens(batch, vocab, key, unk_idx=unk_idx).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")

    w = prepared.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if trigger_once else w).start()


def write_stream(df: DataFrame, path: str, checkpoint: str, trigger_once: bool = True):
    """Parquet sink with its own checkpoint folder (exactly-once file sink)."""
    w = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start(path)
