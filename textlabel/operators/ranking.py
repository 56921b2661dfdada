"""Exact, distributed row numbering.

A global ``row_number().over(Window.orderBy(...))`` moves every row into one task. The two
helpers here give the same numbers with bounded work per task:

* ``hash_rank``: the order key is an md5 hex string (uniform), so its first hex digits
  split the rows into equal buckets. Counting per bucket gives a table of at most
  16**digits rows whose prefix sums are the bucket offsets; a per-bucket window then
  numbers the rows. Deterministic under any partitioning, so a lost executor recomputes
  the same answer from lineage.
* ``sorted_index``: any total order. A range-partitioned sort (sampled bounds, so a hot
  value cannot land in one task when the key is unique) is checkpointed to the shared
  checkpoint folder, which fixes the layout; per-partition counts become offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id: partition id << 33 | row number


def md5_key(seed, *cols) -> Column:
    """md5 hex of 'seed:col1:col2…' — the repeatable random order key used everywhere."""
    parts = [F.lit(str(seed))]
    for c in cols:
        parts += [F.lit(":"), (F.col(c) if isinstance(c, str) else c).cast("string")]
    return F.md5(F.concat(*parts))


def md5_unit(key: Column, digits: int = 8) -> Column:
    """First ``digits`` hex digits of an md5 key as a non-negative integer."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("long")


def hash_rank(df: DataFrame, key: str, tiebreak: str, rank_col: str = "rank",
              total_col: str | None = "n_total", digits: int = 4) -> DataFrame:
    """1-based rank of each row by (key, tiebreak); ``key`` must be an md5 hex column.

    ``digits`` = 4 gives 65,536 buckets: 10^11 rows are ~1.5M rows per window task, and the
    offset table (one row per non-empty bucket) stays a ~1.5 MB broadcast.
    """
    bucket = F.conv(F.substring(F.col(key), 1, digits), 16, 10).cast("int")
    with_bucket = df.withColumn("_bucket", bucket)
    counts = with_bucket.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # <= 16**digits rows: the prefix sum runs on one task and is broadcast by proof of size.
    w = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_bucket",
        F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
    )
    within = Window.partitionBy("_bucket").orderBy(F.col(key), F.col(tiebreak))
    out = (with_bucket.join(F.broadcast(offsets), "_bucket")
           .withColumn(rank_col, F.col("_offset") + F.row_number().over(within)))
    if total_col:
        out = out.withColumn(total_col, F.col("_total"))
    return out.drop("_bucket", "_offset", "_total")


def sorted_index(df: DataFrame, order: list[Column], index_col: str = "idx",
                 start: int = 0) -> DataFrame:
    """Dense 0-based (+ ``start``) position of each row in ``order`` (must be a total order)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # An explicit range repartition keeps the configured width: AQE would coalesce a small
    # sorted result into one partition and every later per-row step would run on one core.
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid_out = (df.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
                .withColumn("_mid", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    part = F.shiftright(F.col("_mid"), 33)
    counts = laid_out.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: bounded by the partition count.
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    return (laid_out.withColumn("_part", part)
            .join(F.broadcast(offsets), "_part")
            .withColumn(index_col, (F.col("_offset") + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))
                                    + F.lit(start)).cast("long"))
            .drop("_part", "_offset", "_mid"))


def size_checked_broadcast(df: DataFrame, max_rows: int = 2_000_000) -> DataFrame:
    """Broadcast ``df`` only when it is proven small; otherwise leave the join to
    sort-merge / AQE. Call it on materialised (checkpointed or tiny) inputs only."""
    return F.broadcast(df) if df.count() <= max_rows else df


def rank_cutoffs(df: DataFrame, key: Column, tiebreak: str, positions, digits: int = 4) -> DataFrame:
    """The (key, tiebreak) values found at given 1-based positions of the (key, tiebreak)
    order, as ONE row: ``n`` plus ``_ck{i}`` / ``_ci{i}`` for each position (null when the
    position is < 1, i.e. "nothing is at or before it").

    ``positions(n)`` maps the row-count Column to a list of position Columns. Only the narrow
    (tiebreak, key) columns are read: bucket counts give the bucket that holds each position,
    and just those buckets (about n / 16**digits rows each) are ranked. A caller then
    classifies every row with a comparison against this broadcast row — the wide rows are
    never shuffled.
    """
    narrow = df.select(F.col(tiebreak).alias("_id"), key.alias("_key")).withColumn(
        "_bucket", F.conv(F.substring("_key", 1, digits), 16, 10).cast("int"))
    counts = narrow.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", "_n", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"),
                            F.sum("_n").over(Window.partitionBy()).alias("n"))
    total = offsets.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"))
    pos = total.select("n", F.posexplode(F.array(*[p.cast("long") for p in positions(F.col("n"))])).alias("i", "p"))
    # the bucket holding each position (<= len(positions) rows)
    where = (offsets.join(F.broadcast(pos), (F.col("p") > F.col("_off")) & (F.col("p") <= F.col("_off") + F.col("_n")))
             .select("i", "_bucket", (F.col("p") - F.col("_off")).alias("_local")))
    within = Window.partitionBy("_bucket").orderBy("_key", "_id")
    picked = (narrow.join(F.broadcast(where.select("_bucket").distinct()), "_bucket")
              .withColumn("_r", F.row_number().over(within))
              .join(F.broadcast(where), ["_bucket"])
              .filter(F.col("_r") == F.col("_local"))
              .select("i", "_key", "_id"))
    cols = [F.max(F.when(F.col("i") == j, F.col("_key"))).alias(f"_ck{j}") for j in range(len(positions(F.lit(0))))]
    cols += [F.max(F.when(F.col("i") == j, F.col("_id"))).alias(f"_ci{j}") for j in range(len(positions(F.lit(0))))]
    return total.crossJoin(picked.agg(*cols))


def at_or_before(key: Column, tiebreak: Column, j: int) -> Column:
    """Row (key, tiebreak) is at or before cut-off ``j`` of a ``rank_cutoffs`` row."""
    ck, ci = F.col(f"_ck{j}"), F.col(f"_ci{j}")
    return F.coalesce((key < ck) | ((key == ck) & (tiebreak <= ci)), F.lit(False))
