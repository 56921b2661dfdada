"""Bag-of-words features from a distributed dictionary (AG11, AG12): term numbers and scales are a table, joined by blocks of documents.

Neither the vocabulary nor a vector of its length passes through the driver to make features: terms are numbered by a distributed sort,
their scales are one aggregation, and a document's sparse row is looked up in its block (``operators.lookup``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lookup as LK
from .features import bow_scale_stats
from .linear import ARROW, BLOCKS, block_row
from .ranking import sorted_index


def fit_terms(train: DataFrame, n_rows: int, tokens: str = "tokens", key: str = "doc_id") -> DataFrame:
    """AG11 + AG12: (token, idx, scale) of every term of the training rows, stored; idx in the order of the terms, from 0. The scale is the
    population std of the counts (scikit-learn's ``StandardScaler(with_mean=False)``); a constant term keeps 1."""
    tf = train.select(key, F.explode(tokens).alias("token")).groupBy(key, "token").agg(F.count(F.lit(1)).alias("tf"))
    return sorted_index(bow_scale_stats(tf, n_rows).select("token", "scale"), [F.col("token").asc()], "idx")


def _counted(documents: pa.Table, entries: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, entry and count of each distinct known (row, word) of a block, in order."""
    words, per_sentence, per_row = LK.flat_words(documents.column("_tokens"))
    at = LK.places(words, entries)
    row = np.repeat(np.repeat(np.arange(len(per_row)), per_row), per_sentence)
    known = at >= 0
    wide = max(entries.num_rows, 1)
    pair, count = np.unique(row[known] * wide + at[known], return_counts=True)
    return pair // wide, pair % wide, count


def term_blocks(df: DataFrame, terms: DataFrame, label_cols: list[str], tokens: str = "tokens") -> DataFrame:
    """Stored training blocks (``operators.linear``) of the scaled term counts, with 0/1 labels; words outside ``terms`` do not count."""
    laid = LK.in_blocks(df.select(F.array(*[F.col(c).cast("double") for c in label_cols]).alias("_y"), LK.nested(df, tokens).alias("_tokens")))

    def fold(documents: pa.Table, entries: pa.Table) -> pa.Table:
        row, entry, count = _counted(documents, entries)
        n = documents.num_rows
        vals = count / entries.column("scale").to_numpy()[entry]
        y = documents.column("_y").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        starts = LK.offsets(np.bincount(row, minlength=n))
        return pa.Table.from_pylist([block_row(y, starts, entries.column("idx").to_numpy()[entry], vals)] if n else [], schema=ARROW)

    return LK.look_up(laid, "_tokens", terms, fold, BLOCKS).checkpoint(eager=True)


def term_scores(df: DataFrame, weights: DataFrame, intercepts: list[float], key: str, tokens: str = "tokens", out: str = "margins") -> DataFrame:
    """(key, out: array<double>) the margin of every row for every label. ``weights``: (token, w: array<double>), the weight of one occurrence
    for each label, or scale and weight already divided."""
    laid = LK.in_blocks(df.select(F.col(key), LK.nested(df, tokens).alias("_tokens")))
    kind = laid.schema[key].dataType.simpleString()
    start = np.array(intercepts, dtype=np.float64)

    def fold(documents: pa.Table, entries: pa.Table) -> pa.Table:
        row, entry, count = _counted(documents, entries)
        w = entries.column("w").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(start))
        sums = [np.bincount(row, count * w[entry, j], documents.num_rows) + start[j] for j in range(len(start))]
        margins = LK.lists(pa.array(np.stack(sums, axis=1).ravel()), np.full(documents.num_rows, len(start)))
        return pa.table([documents.column(key), margins], names=[key, out])

    return LK.look_up(laid, "_tokens", weights.select("token", "w"), fold, f"`{key}` {kind}, `{out}` array<double>")
