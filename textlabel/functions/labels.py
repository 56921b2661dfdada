"""Label expressions (PRJ2-PRJ5, FLT1, MTH1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def encode_strict(c, mode: str = "strict") -> Column:
    """PRJ2: 'y' -> 1, 'n' -> 0, null stays null; any other value raises (``strict``)
    or becomes null (``null``)."""
    c = _col(c)
    other = (F.raise_error(F.concat(F.lit("label value is not y/n: "), c))
             if mode == "strict" else F.lit(None))
    return (F.when(c.isNull(), F.lit(None))
             .when(c == "y", F.lit(1))
             .when(c == "n", F.lit(0))
             .otherwise(other).cast("int"))


def encode_lenient(c) -> Column:
    """PRJ3: 1 when the value is 'y', otherwise 0 (null included)."""
    return F.coalesce(_col(c) == "y", F.lit(False)).cast("int")


def frame_replace(df: DataFrame, label_cols: list[str], mapping: dict | None = None) -> DataFrame:
    """PRJ4: whole-frame value replace (every string column, text included), then the
    label columns become integers."""
    mapping = mapping or {"y": "1", "n": "0"}
    out = df.replace(mapping)
    for c in label_cols:
        out = out.withColumn(c, F.col(c).cast("int"))
    return out


def label_vector(label_cols: list[str]) -> Column:
    """PRJ5: labels packed as array<float>; a single label stays a scalar float."""
    if len(label_cols) == 1:
        return F.col(label_cols[0]).cast("float")
    return F.array(*[F.col(c) for c in label_cols]).cast("array<float>")


def sigmoid(x) -> Column:
    """MTH1."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(x)))


def threshold(score, cutoff=0.5) -> Column:
    """FLT1: score >= cutoff -> 1 else 0."""
    cut = cutoff if isinstance(cutoff, Column) else F.lit(float(cutoff))
    return (_col(score) >= cut).cast("int")
