"""Metrics, best-epoch windows and profiling against pandas / NumPy on small fixtures."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from textlabel.operators import evaluate as E
from textlabel.operators import profile as P

PRED = [  # run, doc, trait, actual, predicted
    (0, 1, "a", 1.0, 1.0), (0, 2, "a", 0.0, 0.0), (0, 3, "a", 1.0, 0.0), (0, 4, "a", 0.0, None),
    (0, 1, "b", 0.0, 0.0), (0, 2, "b", 0.0, 0.0), (0, 3, "b", 0.0, 0.0), (0, 4, "b", 0.0, 0.0),  # no positives
    (1, 1, "a", 1.0, 0.0), (1, 2, "a", 0.0, 1.0), (1, 1, "b", 1.0, 1.0), (1, 2, "b", 1.0, 1.0),
]
SCHEMA = "run long, doc_id long, trait string, actual double, predicted double"


def _pandas_metrics(pdf):
    out = {}
    for (run, trait), g in pdf.groupby(["run", "trait"]):
        p, a = g["predicted"], g["actual"]
        tp = ((p == 1) & (a == 1)).sum(); fp = ((p == 1) & (a == 0)).sum(); fn = ((p == 0) & (a == 1)).sum()
        out[(run, trait)] = ((p == a).mean(), tp / (tp + fp) if tp + fp else 0.0, tp / (tp + fn) if tp + fn else 0.0)
    return out


def test_precision_recall_accuracy(spark):
    cells = spark.createDataFrame(PRED, SCHEMA)
    pdf = pd.DataFrame(PRED, columns=["run", "doc_id", "trait", "actual", "predicted"])
    want = _pandas_metrics(pdf)
    acc = {(r["run"], r["trait"]): r["accuracy"] for r in E.trait_accuracy(cells, ["run"]).collect()}
    pr = {(r["run"], r["trait"]): (r["precision"], r["recall"]) for r in E.precision_recall(cells, ["run"]).collect()}
    for k, (a, p, r) in want.items():
        assert acc[k] == pytest.approx(a) and pr[k] == pytest.approx((p, r))
    micro = {r["run"]: r["accuracy"] for r in E.micro_accuracy(cells, ["run"]).collect()}
    assert micro[0] == pytest.approx(6 / 8) and micro[1] == pytest.approx(2 / 4)


def test_run_average(spark):
    cells = spark.createDataFrame(PRED, SCHEMA)
    avg = {(r["metric"], r["trait"]): r["value"] for r in E.run_average_metrics(E.metric_table(cells)).collect()}
    assert avg[("overall_accuracy", "all")] == pytest.approx((6 / 8 + 2 / 4) / 2)
    assert avg[("precision", "b")] == pytest.approx((0.0 + 1.0) / 2)


def _py_trace(losses, accs):
    best_l, best_a, out = float("inf"), 0.0, []
    for l, a in zip(losses, accs):
        fl, fa = l < best_l, a > best_a
        best_l, best_a = (l if fl else best_l), (a if fa else best_a)
        out.append((fl, fa))
    return out


@pytest.mark.parametrize("chunk", [3, 4096])
def test_best_epoch_trace_chunked(spark, chunk):
    rng = np.random.default_rng(1)
    rows = []
    for run in range(3):
        n = 1 if run == 2 else 40
        loss = np.round(rng.uniform(0, 1, n), 2)
        acc = np.round(rng.uniform(0, 1, n), 2)
        rows += [(run, e, float(loss[e]), float(acc[e])) for e in range(n)]
    log = spark.createDataFrame(rows, "run long, epoch long, val_loss double, val_acc double")
    got = {(r["run"], r["epoch"]): (r["best_loss_so_far"], r["best_acc_so_far"])
           for r in E.best_epoch_trace(log, chunk=chunk).collect()}
    for run in range(3):
        rs = [r for r in rows if r[0] == run]
        want = _py_trace([r[2] for r in rs], [r[3] for r in rs])
        assert [got[(run, r[1])] for r in rs] == want
    best = {r["run"]: r for r in E.best_epoch(log).collect()}
    for run in range(3):
        rs = [r for r in rows if r[0] == run]
        flags = _py_trace([r[2] for r in rs], [r[3] for r in rs])
        assert best[run]["best_loss_epoch"] == max(i for i, f in enumerate(flags) if f[0])
        acc_flags = [i for i, f in enumerate(flags) if f[1]]
        assert best[run]["best_acc_epoch"] == (max(acc_flags) if acc_flags else None)


def test_batch_mean_and_bce(spark):
    log = spark.createDataFrame([(0, 0, 0, 1.0), (0, 0, 0, 3.0), (0, 0, 1, 10.0)], "run long, epoch long, batch long, loss double")
    r = E.batch_mean_loss(log, ["run", "epoch"]).first()
    assert r["epoch_loss"] == pytest.approx((2.0 + 10.0) / 2)
    cells = spark.createDataFrame([(2.0, 1.0), (-1.0, 0.0)], "logit double, actual double")
    x, y = np.array([2.0, -1.0]), np.array([1.0, 0.0])
    want = np.mean(np.log1p(np.exp(-np.abs(x))) + np.maximum(x, 0) - x * y)
    assert E.bce_loss(cells).first()["bce"] == pytest.approx(want)


def test_describe_and_boxplot_match_pandas(spark):
    texts = ["x" * n for n in [1, 2, 2, 3, 5, 8, 13, 21, 34, 200]]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    s = pd.Series([len(t) for t in texts])
    d = P.describe_length(df).first()
    want = s.describe()
    for k, w in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                 ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
        assert d[k] == pytest.approx(want[w])
    b = P.length_boxplot(df).first()
    q1, q3 = np.percentile(s, [25, 75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert b["whisker_low"] == s[s >= lo].min() and b["whisker_high"] == s[s <= hi].max()
    assert b["n_outliers"] == int(((s < lo) | (s > hi)).sum())


def test_profile_tables(spark):
    df = spark.createDataFrame([("y", "n", "t1"), ("y", None, "t2"), ("n", "n", None)], "a string, b string, text string")
    nulls = {r["column_name"]: r["n_missing"] for r in P.null_counts(df).collect()}
    assert nulls == {"a": 0, "b": 1, "text": 1}
    info = {r["column_name"]: (r["dtype"], r["non_null"]) for r in P.frame_info(df).collect()}
    assert info["b"] == ("string", 2)
    vc = {r["value"]: (r["a"], r["b"]) for r in P.label_value_counts(df, ["a", "b"]).collect()}
    assert vc == {"y": (2, 0), "n": (1, 2)}
    nums = spark.createDataFrame([(1, 0, "aa"), (1, 1, "a"), (0, 1, "aaaa"), (0, 0, "aaa")], "a int, b int, text string")
    corr = {(r["trait_a"], r["trait_b"]): r["corr"] for r in P.label_corr(nums, ["a", "b"]).collect()}
    pdf = pd.DataFrame({"a": [1, 1, 0, 0], "b": [0, 1, 1, 0]})
    assert corr[("a", "b")] == pytest.approx(pdf.corr().loc["a", "b"]) and corr[("b", "b")] == pytest.approx(1.0)
    lc = {r["trait"]: r["corr"] for r in P.length_label_corr(nums, ["a"]).collect()}
    assert lc["a"] == pytest.approx(np.corrcoef([1, 1, 0, 0], [2, 1, 4, 3])[0, 1])


def test_top_words(spark):
    df = spark.createDataFrame([([["b", "a"], ["a", "<pad>"]],), ([["c", "b", "a"]],)], "tokens array<array<string>>")
    got = [(r["word"], r["n"]) for r in P.top_words(df, k=2, stop_words=["<pad>"]).collect()]
    assert got == [("a", 3), ("b", 2)]


def test_approx_quantiles_close_to_exact(spark):
    df = spark.createDataFrame([("x" * n,) for n in range(1, 2001)], "text string")
    exact = P.describe_length(df).first()
    approx = P.describe_length(df, approx=True).first()
    for k in ("p25", "p50", "p75"):
        assert abs(exact[k] - approx[k]) <= 2.0


@pytest.mark.parametrize("kind", ["spread", "copies", "two", "few", "empty"])
def test_exact_quantiles_of_any_distribution(spark, monkeypatch, kind):
    from textlabel.operators import profile as P
    monkeypatch.setattr(P, "SMALL", 50)  # so that bounds are narrowed in passes
    rng = np.random.default_rng(2)
    values = {"spread": np.sign(rng.normal(size=20_000)) * 10.0 ** rng.uniform(-300, 300, 20_000), "copies": rng.integers(0, 9, 20_000).astype(float),
              "two": np.array([0.0] * 9000 + [5.0] + [1e9] * 9000), "few": np.array([3.0, 1.0]), "empty": np.array([])}[kind]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(7)
    got = P.exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.77, 1.0]).first()
    if not len(values):
        assert tuple(got) == (None,) * 5
    else:
        assert np.allclose(list(got), np.quantile(values, [0.0, 0.25, 0.5, 0.77, 1.0]), rtol=1e-12)


def test_correlations_by_pairs_of_present_values(spark):
    from textlabel.operators.moments import correlations
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 6)) + 1e8  # large means, small spread
    x[:, 3] = x[:, 1] * 2 + rng.normal(size=500)
    x[:, 4] = 7.0
    rows = [tuple(None if rng.random() < 0.1 else float(v) for v in r) for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(6))).repartition(5)
    got = correlations(df, {c: F.col(c) for c in df.columns})
    table = pd.DataFrame(rows, columns=df.columns, dtype=float) - 1e8
    assert np.allclose(np.nan_to_num(got, nan=9.0), np.nan_to_num(table.corr().values, nan=9.0), atol=1e-6)
    assert got[1, 3] == pytest.approx(df.agg(F.corr("c1", "c3")).first()[0], abs=1e-6)
    assert np.isnan(correlations(df.limit(0), {c: F.col(c) for c in df.columns})).all()
    many = spark.range(300).select(*[(F.rand(i) + F.col("id") * (i % 3)).alias(f"m{i}") for i in range(200)])
    assert correlations(many, {c: F.col(c) for c in many.columns}).shape == (200, 200)
