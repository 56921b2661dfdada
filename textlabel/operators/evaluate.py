"""Multi-label evaluation (AG13-AG21, SET1, WN3, WN4, JN4).

Everything works on the long table ``(run, doc_id, trait, actual, predicted)``: one row per
(row, label) cell, so per-label and overall numbers are plain grouped aggregates with
map-side partial aggregation (hot traits or runs are combined before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def long_cells(actual: DataFrame, predicted: DataFrame, label_cols: list[str],
               key: str = "doc_id", run: str | None = None) -> DataFrame:
    """JN4: align actual and predicted by key (inner equi-join), unpivot to one row per cell.

    ``predicted`` holds one column per label (numbers or null); a missing key counts wrong.
    """
    a = actual.select(key, F.struct(*[F.col(c).cast("double").alias(c) for c in label_cols]).alias("_actual"))
    ids = [key] + ([run] if run else [])
    p = predicted.select(*ids, F.struct(*[F.col(c).cast("double").alias(c) for c in label_cols]).alias("_predicted"))
    # one join on the key, then one row per cell: the labels are not shuffled once each
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("trait"), F.col("_actual")[c].alias("actual"), F.col("_predicted")[c].alias("predicted"))
                                for c in label_cols])).alias("_cell")
    return a.join(p, key).select(*([run] if run else []), key, cells).select(*([run] if run else []), key, "_cell.*")


def _correct():
    return F.coalesce(F.col("actual") == F.col("predicted"), F.lit(False)).cast("double")


def micro_accuracy(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AG13: share of correct (row, label) cells."""
    by = by or []
    return cells.groupBy(*by).agg(F.avg(_correct()).alias("accuracy"))


def trait_accuracy(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AG14: accuracy per label."""
    by = (by or []) + ["trait"]
    return cells.groupBy(*by).agg(F.avg(_correct()).alias("accuracy"))


def confusion_counts(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AG15: TP / FP / FN / TN per label."""
    by = (by or []) + ["trait"]
    p1, a1 = F.col("predicted") == 1, F.col("actual") == 1
    p0, a0 = F.col("predicted") == 0, F.col("actual") == 0
    return cells.groupBy(*by).agg(
        F.count_if(p1 & a1).alias("tp"), F.count_if(p1 & a0).alias("fp"),
        F.count_if(p0 & a1).alias("fn"), F.count_if(p0 & a0).alias("tn"))


def precision_recall(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AG16: precision and recall per label, 0 when the denominator is 0."""
    by = by or []
    c = confusion_counts(cells, by)
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    return c.select(*by, "trait", prec.alias("precision"), rec.alias("recall"))


def metric_table(cells: DataFrame, run: str = "run") -> DataFrame:
    """Per-run metrics in long form (run, metric, trait, value); SET1 stacks them.

    One aggregation of the cells: counts for each (run, trait), from which every metric follows; the overall accuracy sums them.
    """
    p1, a1 = F.col("predicted") == 1, F.col("actual") == 1
    p0, a0 = F.col("predicted") == 0, F.col("actual") == 0
    counts = cells.groupBy(run, "trait").agg(F.sum(_correct()).alias("right"), F.count(F.lit(1)).alias("n"), F.count_if(p1 & a1).alias("tp"),
                                             F.count_if(p1 & a0).alias("fp"), F.count_if(p0 & a1).alias("fn"))
    def share(x, y):
        return F.when(F.col("tp") + F.col(y) > 0, F.col("tp") / (F.col("tp") + F.col(y))).otherwise(0.0)

    # a run has one row a trait here: they are few, and give its overall row too
    of_run = counts.groupBy(run).agg((F.sum("right") / F.sum("n")).alias("overall"), F.collect_list(F.struct(
        "trait", (F.col("right") / F.col("n")).alias("accuracy"), share("tp", "fp").alias("precision"), share("tp", "fn").alias("recall"))).alias("traits"))
    row = lambda metric, trait, value: F.struct(F.lit(metric).alias("metric"), trait.alias("trait"), value.alias("value"))

    def of_traits(metric):
        return F.transform("traits", lambda t: row(metric, t["trait"], t[metric]))

    rows = F.concat(F.array(row("overall_accuracy", F.lit("all"), F.col("overall"))), *map(of_traits, ("accuracy", "precision", "recall")))
    return of_run.select(run, F.explode(rows).alias("_m")).select(run, "_m.*")


def run_average_metrics(metrics: DataFrame, run: str = "run") -> DataFrame:
    """AG17: mean over runs of every (metric, trait)."""
    return metrics.groupBy("metric", "trait").agg(F.avg("value").alias("value"),
                                                 F.count(run).alias("n_runs"))


def bce_with_logits(x, y) -> F.Column:
    """AG21 cell loss, numerically stable: max(x,0) - x*y + log1p(exp(-|x|))."""
    return F.greatest(x, F.lit(0.0)) - x * y + F.log1p(F.exp(-F.abs(x)))


def bce_losses(cells: DataFrame, logit: str = "logit") -> DataFrame:
    """AG21 both ways in one pass: (bce, bce_double_sigmoid)."""
    x = F.col(logit).cast("double")
    return cells.agg(F.avg(bce_with_logits(x, F.col("actual"))).alias("bce"),
                     F.avg(bce_with_logits(F.lit(1.0) / (F.lit(1.0) + F.exp(-x)), F.col("actual"))).alias("bce_double_sigmoid"))


def accuracy_rollup(cells: DataFrame, key: str = "doc_id") -> DataFrame:
    """AG13, AG14, AG19 in one pass: (trait, accuracy, n_rows) for every trait and for ``all``; n_rows counts distinct keys."""
    hit = F.when(F.col("actual") == F.col("predicted"), 1.0).otherwise(0.0)
    per_row = cells.groupBy(key, "trait").agg(F.sum(hit).alias("_hits"), F.count(F.lit(1)).alias("_cells"))
    per_key = per_row.groupBy(key).agg(F.collect_list(F.struct("trait", "_hits", "_cells")).alias("_t"), F.sum("_hits").alias("_hits"), F.sum("_cells").alias("_cells"))
    both = F.concat("_t", F.array(F.struct(F.lit("all").alias("trait"), "_hits", "_cells")))  # a key has as many entries as there are traits
    rows = per_key.select(F.explode(both).alias("t")).select("t.*")
    return rows.groupBy("trait").agg((F.sum("_hits") / F.sum("_cells")).alias("accuracy"), F.count(F.lit(1)).alias("n_rows"))


def bce_loss(cells: DataFrame, logit: str = "logit", double_sigmoid: bool = False,
             by: list[str] | None = None) -> DataFrame:
    """AG21: mean BCE-with-logits over cells; ``double_sigmoid`` feeds sigmoid(logit) as the
    logit (quirk Q3, for parity with the reference's training loss)."""
    x = F.col(logit).cast("double")
    if double_sigmoid:
        x = F.lit(1.0) / (F.lit(1.0) + F.exp(-x))
    return cells.groupBy(*(by or [])).agg(F.avg(bce_with_logits(x, F.col("actual"))).alias("bce"))


def batch_mean_loss(log: DataFrame, by: list[str], batch: str = "batch",
                    loss: str = "loss") -> DataFrame:
    """AG20: epoch loss = mean over batches of the batch mean loss."""
    per_batch = log.groupBy(*by, batch).agg(F.avg(loss).alias("_batch_loss"))
    return per_batch.groupBy(*by).agg(F.avg("_batch_loss").alias("epoch_loss"),
                                      F.count(F.lit(1)).alias("n_batches"))


def best_epoch_trace(log: DataFrame, run: str = "run", epoch: str = "epoch",
                     loss: str = "val_loss", acc: str = "val_acc",
                     chunk: int = 4096) -> DataFrame:
    """WN3: flag each epoch that improves the running best (loss strictly lower than every
    earlier epoch; accuracy strictly higher than every earlier one and than 0.0).

    A running min over one run is a prefix scan. To keep a hot run from landing in one task,
    epochs are cut into ``chunk``-wide ranges: per-chunk extremes are prefix-scanned on the
    (chunk-times smaller) chunk table, and each chunk scans its own rows.
    """
    c = F.floor(F.col(epoch) / chunk).cast("long")
    rows = log.withColumn("_chunk", c)
    per_chunk = rows.groupBy(run, "_chunk").agg(F.min(loss).alias("_cmin"), F.max(acc).alias("_cmax"))
    wc = Window.partitionBy(run).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    prior = per_chunk.select(run, "_chunk", F.min("_cmin").over(wc).alias("_pmin"),
                             F.max("_cmax").over(wc).alias("_pmax"))
    wi = Window.partitionBy(run, "_chunk").orderBy(epoch).rowsBetween(Window.unboundedPreceding, -1)
    traced = rows.join(prior, [run, "_chunk"]).select(
        "*", F.min(loss).over(wi).alias("_imin"), F.max(acc).over(wi).alias("_imax"))
    best_loss_before = F.least("_pmin", "_imin")           # least() skips nulls
    best_acc_before = F.greatest("_pmax", "_imax", F.lit(0.0))
    return traced.select(
        run, epoch, loss, acc,
        (best_loss_before.isNull() | (F.col(loss) < best_loss_before)).alias("best_loss_so_far"),
        (F.col(acc) > best_acc_before).alias("best_acc_so_far"))


def best_epoch(log: DataFrame, run: str = "run", epoch: str = "epoch",
               loss: str = "val_loss", acc: str = "val_acc") -> DataFrame:
    """WN4: the epoch kept by each criterion; ties keep the first epoch."""
    return log.groupBy(run).agg(
        F.min_by(F.col(epoch), F.struct(F.col(loss), F.col(epoch))).alias("best_loss_epoch"),
        F.min(loss).alias("best_loss"),
        F.when(F.max(acc) > 0, F.min_by(F.col(epoch), F.struct((-F.col(acc)).alias("a"), F.col(epoch).alias("e"))))
         .alias("best_acc_epoch"),
        F.max(acc).alias("best_acc"))
