"""Corpus profiling (AG1-AG7, AG22, SET3): every statistic is one aggregation pass.

Quantiles are exact, interpolated linearly as pandas/NumPy do: the ranks around each are selected by passes that narrow
bounds (``values_at``). ``approx=True`` switches to ``percentile_approx``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import text_length
from ..session import ensure_checkpoint_dir
from .moments import correlations


def _stack(df_one_row: DataFrame, names: list[str], value_cols: list[str], name_col: str,
           value_names: list[str]) -> DataFrame:
    """Turn one wide row into one row per name (unpivot of several value groups)."""
    structs = [F.struct(F.lit(n).alias(name_col),
                        *[F.col(f"{vc}__{i}").alias(vn) for vc, vn in zip(value_cols, value_names)])
               for i, n in enumerate(names)]
    return df_one_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def frame_info(df: DataFrame) -> DataFrame:
    """AG1: column, dtype, non-null count — one pass."""
    cols = df.columns
    wide = df.agg(*[F.count(F.col(c)).alias(f"nn__{i}") for i, c in enumerate(cols)])
    dtypes = dict(df.dtypes)
    out = _stack(wide, cols, ["nn"], "column_name", ["non_null"])
    mapping = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(dtypes[c]))])
    return out.select("column_name", mapping[F.col("column_name")].alias("dtype"), "non_null")


def null_counts(df: DataFrame) -> DataFrame:
    """AG2: missing values per column — one pass."""
    cols = df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulls__{i}") for i, c in enumerate(cols)])
    return _stack(wide, cols, ["nulls"], "column_name", ["n_missing"])


def label_value_counts(df: DataFrame, label_cols: list[str]) -> DataFrame:
    """AG3: value x label count matrix, missing combinations 0."""
    long = df.unpivot([], label_cols, "trait", "value").filter(F.col("value").isNotNull())
    wide = long.groupBy("value").pivot("trait", label_cols).agg(F.count(F.lit(1)))
    return wide.na.fill(0, subset=label_cols)


def label_counts_long(df: DataFrame, label_cols: list[str]) -> DataFrame:
    """SET3: the matrix of AG3 melted to (value, trait, count)."""
    return label_value_counts(df, label_cols).unpivot(["value"], label_cols, "trait", "count")


def label_corr(df: DataFrame, label_cols: list[str]) -> DataFrame:
    """AG4: Pearson correlation of every label pair, long form; one scan for any number of labels."""
    corr = correlations(df, {c: F.col(c) for c in label_cols})
    rows = [(a, b, _or_null(corr[i, j])) for i, a in enumerate(label_cols) for j, b in enumerate(label_cols)]
    return df.sparkSession.createDataFrame(rows, "trait_a string, trait_b string, corr double")


def length_label_corr(df: DataFrame, label_cols: list[str], text: str = "text") -> DataFrame:
    """AG5: correlation of each label with the text length."""
    corr = correlations(df, {"": text_length(text), **{c: F.col(c) for c in label_cols}})
    return df.sparkSession.createDataFrame([(c, _or_null(corr[0, i + 1])) for i, c in enumerate(label_cols)], "trait string, corr double")


def _or_null(x: float) -> float | None:
    return None if x != x else float(x)


#: values between the bounds of a rank that are looked at one by one; the resolution of a pass
SMALL, RESOLUTION = 10_000, 1000


def values_at(stored: DataFrame, col: str, ranks: list[int]) -> list:
    """The values at 0-based ``ranks`` of the ordered non-null values, exactly. Each pass takes two approximate percentiles around a rank,
    counts what lies below, at and between them, and either has found the value or goes on between the two, with about 4 / ``RESOLUTION``
    of the values; at most ``SMALL`` are looked at one by one. All ranks share a pass, whatever the values' distribution."""
    v = F.col(col)
    total = stored.agg(F.count(v).alias("n")).first()["n"]
    state = {r: (None, None, 0, total) for r in ranks}  # open bounds, values up to the lower one, values between
    found: dict = {}

    def between(low, high):
        return v.isNotNull() if low is None else (v > low) & (v < high)

    while state:
        for r, (low, high, below, n) in list(state.items()):
            if n <= SMALL:
                counted = stored.filter(between(low, high)).groupBy(v.alias("v")).agg(F.count(F.lit(1)).alias("n")).collect()
                for row in sorted(counted, key=lambda x: x["v"]):
                    below += row["n"]
                    if below > r:
                        found[r] = row["v"]
                        break
                del state[r]
        if not state:
            break
        marks, e = [], 2.0 / RESOLUTION
        for r, (low, high, below, n) in state.items():
            share = (r - below + 0.5) / n
            marks.append(F.percentile_approx(F.when(between(low, high), v), F.array(F.lit(max(0.0, share - e)), F.lit(min(1.0, share + e))), RESOLUTION).alias(str(r)))
        near = {r: tuple(x) for r, x in zip(state, stored.agg(*marks).first())}
        counts = stored.agg(*[F.struct(F.count_if(v < a), F.count_if(v == a), F.count_if((v > a) & (v < b)), F.count_if((v == b) & (v > a))).alias(str(r))
                              for r, (a, b) in near.items()]).first()
        for (r, (a, b)), (less, at_a, mid, at_b) in zip(near.items(), counts):
            if not less <= r < less + at_a + mid + at_b:
                raise RuntimeError(f"rank {r} of {total} left its bounds")  # beyond the error that percentile_approx states
            if less + at_a <= r < less + at_a + mid:
                state[r] = (a, b, less + at_a, mid)
            else:
                found[r] = a if r < less + at_a else b
                del state[r]
    return [found[r] for r in ranks]


def exact_quantiles(df: DataFrame, col: str, probs: list[float], approx: bool = False) -> DataFrame:
    """Linear-interpolated quantiles as one row with columns q0, q1, … ``df`` is read several times: store it if it is dear."""
    if approx:
        got = df.agg(F.percentile_approx(F.col(col), F.array(*[F.lit(p) for p in probs]), 100000).alias("qs"))
        return got.select(*[F.col("qs")[i].cast("double").alias(f"q{i}") for i in range(len(probs))])
    n = df.agg(F.count(col).alias("n")).first()["n"]
    ends = [(p * (n - 1), int(p * (n - 1) // 1)) for p in probs]
    out: list = [None] * len(probs)
    if n:
        ranks = sorted({k for _, k in ends} | {min(k + 1, n - 1) for _, k in ends})
        at = dict(zip(ranks, values_at(df, col, ranks)))
        out = [float(at[k]) + (float(at[min(k + 1, n - 1)]) - float(at[k])) * (pos - k) for pos, k in ends]
    return df.sparkSession.createDataFrame([tuple(out)], ", ".join(f"q{i} double" for i in range(len(probs))))


def _lengths(df: DataFrame, text: str) -> DataFrame:
    """The text lengths, stored: texts are scanned once."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.select(text_length(text).alias("len")).checkpoint(eager=True)


def describe_length(df: DataFrame, text: str = "text", approx: bool = False) -> DataFrame:
    """AG6: count, mean, sample std, min, 25/50/75 %, max of the text length."""
    lens = _lengths(df, text)
    basic = lens.agg(F.count("len").cast("double").alias("count"), F.avg("len").alias("mean"),
                     F.stddev_samp("len").alias("std"), F.min("len").cast("double").alias("min"),
                     F.max("len").cast("double").alias("max"))
    q = exact_quantiles(lens, "len", [0.25, 0.5, 0.75], approx).select(
        F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"))
    return basic.crossJoin(q).select("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def length_boxplot(df: DataFrame, text: str = "text", whis: float = 1.5, approx: bool = False) -> DataFrame:
    """AG7: box-plot statistics of the text length (quartiles, whiskers, outliers)."""
    lens = _lengths(df, text)
    q = exact_quantiles(lens, "len", [0.25, 0.5, 0.75], approx).select(
        F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo = F.col("q1") - F.lit(whis) * F.col("iqr")
    hi = F.col("q3") + F.lit(whis) * F.col("iqr")
    stats = lens.crossJoin(F.broadcast(q)).groupBy("q1", "median", "q3", "iqr").agg(
        F.min(F.when(F.col("len") >= lo, F.col("len"))).cast("double").alias("whisker_low"),
        F.max(F.when(F.col("len") <= hi, F.col("len"))).cast("double").alias("whisker_high"),
        F.count_if((F.col("len") < lo) | (F.col("len") > hi)).alias("n_outliers"))
    return stats


def top_words(df: DataFrame, tokens: str = "tokens", k: int = 50,
              stop_words: list[str] | None = None) -> DataFrame:
    """AG22 + SRT2 + ARR7: the k most frequent words of a tokenised corpus."""
    col = F.col(tokens)
    dtype = df.schema[tokens].dataType.simpleString()
    flat = F.flatten(col) if dtype.startswith("array<array") else col
    words = df.select(F.explode(flat).alias("word"))
    if stop_words:
        words = words.filter(~F.col("word").isin(*stop_words))
    return (words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col("word").asc()).limit(k))
