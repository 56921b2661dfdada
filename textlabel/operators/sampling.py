"""Repeatable samples and splits (SMP1, SMP2, SPL1-SPL3, WN5, MTH3).

Randomness is an md5 key over (seed, row id), never ``rand()``: the same rows come out on
every partitioning, after a lost executor is recomputed, and in SQL.
Split sizes follow Python float arithmetic (``int(0.7 * n)``), so the fractions are
double literals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import at_or_before, hash_rank, md5_key, md5_unit, rank_cutoffs


def with_order_key(df: DataFrame, id_col: str = "doc_id", seed: int = 42,
                   key: str = "_key") -> DataFrame:
    return df.withColumn(key, md5_key(seed, id_col))


def hash_split(df: DataFrame, id_col: str = "doc_id", seed: int = 42,
               fractions=(0.7, 0.15, 0.15), names=("train", "val", "test"),
               out: str = "split") -> DataFrame:
    """SPL1: per-row split by an md5 bucket in [0, 10000); no shuffle, sizes approximate."""
    bucket = md5_unit(md5_key(seed, id_col)) % 10000
    edges, acc = [], 0.0
    for f in fractions[:-1]:
        acc += f
        edges.append(int(round(acc * 10000)))
    expr = F.lit(names[-1])
    for edge, name in reversed(list(zip(edges, names))):
        expr = F.when(bucket < edge, F.lit(name)).otherwise(expr)
    return df.withColumn(out, expr)


def ranked(df: DataFrame, id_col: str = "doc_id", seed: int = 42) -> DataFrame:
    """Exact 1-based position of every row in the seeded order, plus the row total."""
    return hash_rank(with_order_key(df, id_col, seed), "_key", id_col, "_pos", "_n").drop("_key")


def split_sizes(n, rule: str = "halves"):
    """MTH3: (train, val) sizes as Columns; test is the rest.

    ``halves``: train = int(.7n), val = (n - train) // 2 (sequence pipeline).
    ``fixed``: train = int(.7n), val = int(.15n) (encoder pipeline).
    """
    train = F.floor(F.lit(0.7) * n)
    val = F.floor((n - train) / 2) if rule == "halves" else F.floor(F.lit(0.15) * n)
    return train, val


def _classify(df: DataFrame, id_col: str, seed: int, positions, labels: list[str], out: str) -> DataFrame:
    """Label each row by the first cut-off it is at or before (last label otherwise).
    The cut-offs are one broadcast row; the rows themselves are never shuffled."""
    cuts = rank_cutoffs(df, md5_key(seed, id_col), id_col, positions)
    key = md5_key(seed, id_col)
    expr = F.lit(labels[-1])
    for j in reversed(range(len(labels) - 1)):
        expr = F.when(at_or_before(key, F.col(id_col), j), F.lit(labels[j])).otherwise(expr)
    return df.crossJoin(F.broadcast(cuts)).withColumn(out, expr).drop(*cuts.columns)


def exact_split(df: DataFrame, id_col: str = "doc_id", seed: int = 42, rule: str = "halves",
                out: str = "split") -> DataFrame:
    """SPL2: exact-size train/val/test by seeded position."""
    def positions(n):
        train, val = split_sizes(n, rule)
        return [train, train + val]
    return _classify(df, id_col, seed, positions, ["train", "val", "test"], out)


def train_test_split(df: DataFrame, id_col: str = "doc_id", seed: int = 42,
                     test_size: float = 0.2, out: str = "split") -> DataFrame:
    """SPL3: test = ceil(test_size * n) rows (the first in seeded order), the rest train."""
    return _classify(df, id_col, seed, lambda n: [F.ceil(F.lit(float(test_size)) * n)],
                     ["test", "train"], out)


def sample_fraction(df: DataFrame, frac: float, id_col: str = "doc_id", seed: int = 42) -> DataFrame:
    """SMP1: exactly round(frac * n) rows (half to even, as Python's ``round``)."""
    picked = _classify(df, id_col, seed, lambda n: [F.bround(F.lit(float(frac)) * n, 0)],
                       ["in", "out"], "_sample")
    return picked.filter(F.col("_sample") == "in").drop("_sample")


def sample_examples(df: DataFrame, k: int, id_col: str = "doc_id", seed: int = 0) -> DataFrame:
    """SMP2: k rows in seeded order (top-k: each task keeps at most k rows)."""
    keyed = with_order_key(df, id_col, seed)
    return keyed.orderBy("_key", id_col).limit(k).drop("_key")


def batch_positions(df: DataFrame, batch_size: int, id_col: str = "doc_id", seed: int = 42,
                    drop_last: bool = True) -> DataFrame:
    """WN5: position in seeded shuffled order and batch number; with ``drop_last`` the rows
    of the final partial batch are removed."""
    r = ranked(df, id_col, seed).withColumn("pos", F.col("_pos") - 1)
    r = r.withColumn("batch", F.floor(F.col("pos") / batch_size).cast("long"))
    if drop_last:
        r = r.filter(F.col("pos") < F.floor(F.col("_n") / batch_size) * batch_size)
    return r.drop("_pos", "_n")
