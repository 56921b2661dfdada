"""Token frequencies and the vocabulary (AG8, AG9, WN2, SRT1, SET2) and the token -> index
lookup (JN1)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lookup as LK
from .ranking import sorted_index

SPECIALS = ("<unk>", "<pad>")


def token_counts(df: DataFrame | LK.Packed, tokens: str = "tokens") -> DataFrame:
    """AG8: (token, n) over all sentences. ``tokens`` is array<array<string>> or array<string>; of packed documents, those they hold.

    The count is a partial (map-side) + final aggregate, so frequent tokens are combined
    before the shuffle and cannot skew it.
    """
    if isinstance(df, LK.Packed):
        return df.word_counts().groupBy("token").agg(F.sum("n").alias("n"))
    col = F.col(tokens)
    dtype = df.schema[tokens].dataType.simpleString()
    flat = F.flatten(col) if dtype.startswith("array<array") else col
    return (df.select(F.explode(flat).alias("token"))
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))


def build_vocabulary(df: DataFrame | LK.Packed, tokens: str = "tokens", specials=SPECIALS,
                     min_freq: int = 1, max_tokens: int | None = None) -> DataFrame:
    """AG9: specials first (0, 1, …), then tokens by frequency desc, token asc.

    Specials are never repeated even if they occur as tokens (SET2). Indexes come from an
    exact distributed numbering (no single-task global window).
    """
    spark = df.sparkSession
    counts = token_counts(df, tokens).filter(~F.col("token").isin(*specials))
    if min_freq > 1:
        counts = counts.filter(F.col("n") >= min_freq)
    ranked = sorted_index(counts, [F.col("n").desc(), F.col("token").asc()], "idx",
                          start=len(specials))
    if max_tokens is not None:
        ranked = ranked.filter(F.col("idx") < max_tokens)
    head = spark.createDataFrame([(s, i) for i, s in enumerate(specials)], "token string, idx long")
    return head.withColumn("n", F.lit(None).cast("long")).unionByName(
        ranked.select("token", "idx", "n"))


def index_tokens(df: DataFrame, vocab: DataFrame, key: str = "doc_id", tokens: str = "tokens", out: str = "ids", unk_idx: int = 0) -> DataFrame:
    """JN1: array<array<string>> -> array<array<int>> through the vocabulary; unknown -> unk.

    Looked up by blocks of documents (``operators.lookup``): a hot word costs one row per block, and the rows keep their order and
    their empty sentences."""
    laid = LK.in_blocks(df.select(F.col(key), LK.nested(df, tokens).alias("_tokens")))

    def fold(documents: pa.Table, entries: pa.Table) -> pa.Table:
        words, per_sentence, per_row = LK.flat_words(documents.column("_tokens"))
        at = LK.places(words, entries)
        numbers = np.append(entries.column("idx").to_numpy(), unk_idx).astype(np.int32)  # -1, the last one, is for unknown words
        ids = LK.lists(LK.lists(pa.array(numbers[at]), per_sentence), per_row)
        return pa.table([documents.column(key), ids], names=[key, out])

    kind = laid.schema[key].dataType.simpleString()
    return LK.look_up(laid, "_tokens", vocab.select("token", "idx"), fold, f"`{key}` {kind}, `{out}` array<array<int>>")
