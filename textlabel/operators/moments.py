"""Correlations of any number of columns from one scan (AG4, AG5).

Every task turns its rows into matrices over the pairs of columns: rows where both are present, means, variations and the co-variation. Tasks'
matrices are merged, about the square root of them at a time; merging compares means, so that large values with a small spread lose
nothing. The driver gets about the square root of the partitions' matrices.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KIND = "state binary"


def _of_rows(x: np.ndarray) -> np.ndarray:
    """(n, mean of a, variation of a, co-variation) for all pairs (a, b) over the rows where both are present; rows x columns, NaN is missing."""
    there = ~np.isnan(x)
    shift = np.nan_to_num(np.where(there, x, 0).sum(axis=0) / np.maximum(there.sum(axis=0), 1))
    y, m = np.where(there, x - shift, 0.0), there.astype(float)
    n = m.T @ m
    safe = np.maximum(n, 1)
    sums = y.T @ m
    return np.stack([n, sums / safe + shift[:, None] * (n > 0), (y * y).T @ m - sums * sums / safe, y.T @ y - sums * sums.T / safe])


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = a[0] + b[0]
    safe = np.maximum(n, 1)
    far = np.where((a[0] > 0) & (b[0] > 0), b[1] - a[1], 0.0)
    both = a[0] * b[0] / safe
    return np.stack([n, (a[0] * a[1] + b[0] * b[1]) / safe, a[2] + b[2] + far * far * both, a[3] + b[3] + far * far.T * both])


def _states(rows, k: int):
    total = None
    for data in rows:
        one = np.frombuffer(data).reshape(4, k, k)
        total = one if total is None else _merged(total, one)
    return total


def correlations(df: DataFrame, columns: dict[str, Column]) -> np.ndarray:
    """Pearson correlations of all pairs, as Spark's ``corr`` gives them: rows with a null in either column do not count; NaN where a column
    does not vary."""
    k = len(columns)
    src = df.select(F.array(*[F.coalesce(c.cast("double"), F.lit(float("nan"))) for c in columns.values()]).alias("x"))

    def rows(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                one = _of_rows(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k))
                total = one if total is None else _merged(total, one)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["state"])

    def states(batches):
        total = _states((d for batch in batches for d in batch.column(0).to_pylist()), k)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["state"])

    partial = src.mapInArrow(rows, KIND)
    few = max(1, int(src.sparkSession.sparkContext.defaultParallelism ** 0.5))
    found = partial.repartition(few).mapInArrow(states, KIND).collect()  # a row a partition
    total = _states((r["state"] for r in found), k)
    if total is None:
        return np.full((k, k), np.nan)
    with np.errstate(divide="ignore", invalid="ignore"):
        return total[3] / np.sqrt(total[2] * total[2].T)
