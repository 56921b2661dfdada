"""Reading vector columns and choosing a bounded set of pivots, for the two vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """The vector is not null, not empty and holds only finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Binary rows of equal width as a matrix of doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(len(column), -1)


def packed(df: DataFrame, key: str, vector: str, change, schema: str = "node binary") -> DataFrame:
    """(key, binary): ``change(matrix)`` gives the rows to keep as doubles; vectors must be usable and are grouped by width."""
    src = df.filter(usable(vector)).select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fields = src.schema["id"]

    def run(parts):
        for batch in parts:
            column = batch.column(1)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            width = np.diff(column.offsets.to_numpy())
            starts = np.cumsum(width) - width
            out: list = [None] * batch.num_rows
            for w in np.unique(width):
                rows = np.flatnonzero(width == w)
                for r, x in zip(rows, change(flat[starts[rows][:, None] + np.arange(w)])):
                    out[r] = x.tobytes() if x is not None else None
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["id", "node"])

    from pyspark.sql import types as T

    return src.mapInArrow(run, T.StructType([fields, T.StructField("node", T.BinaryType())])).filter("node is not null")


def pivots(nodes: DataFrame, most: int, seed: int, column: str = "node") -> list[bytes]:
    """At most ``most`` distinct rows, chosen by hash: the same for every layout of the table."""
    rows = nodes.select(column).distinct().orderBy(F.xxhash64(column, F.lit(seed)), column).limit(most).collect()
    return [bytes(r[0]) for r in rows]
