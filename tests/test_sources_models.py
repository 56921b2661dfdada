"""CSV in Mac Roman, required columns, JSON and model round trips, logistic regression
against a NumPy Newton solve of the C = 1 objective."""

import json
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlabel.functions import text as TX
from textlabel.operators import models as M
from textlabel.operators import terms as TM
from textlabel.sources import corpus as C
from textlabel.sources import sinks as K


def _write_csv(path, rows, header="#AUTHID,TEXT,cEXT,cNEU,cAGR,cCON,cOPN"):
    body = header + "\n" + "\n".join(rows) + "\n"
    with open(path, "wb") as f:
        f.write(body.encode("mac_roman"))


def test_csv_mac_roman_multiline(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "essays.csv")
    _write_csv(p, ['a1,"Café ’quoted’ ""x""\nsecond line",y,n,y,n,x', 'a2,plain,n,y,,n,y'])
    df = C.load_dataset(spark, p)
    rows = {r["#AUTHID"]: r for r in df.collect()}
    assert rows["a1"]["TEXT"] == 'Café ’quoted’ "x"\nsecond line'
    assert rows["a1"]["cOPN"] == "x" and rows["a2"]["cAGR"] is None


ODD_CSV = ['a1,"Café ’quoted’ ""x""\nsecond line\n\n,""",y,n', "a2,plain,n,", '"a3","""","",""', "", 'a4,"\n\n""\n",x,y', "a5,,,"]
ODD_CSV += [f'b{i},"{"line of text é" * (i % 40)}\n""{i}"" , end\n",{"yn"[i % 2]},n' for i in range(300)] + ['c,"' + "long\n" * 3000 + '",y,n']


@pytest.mark.parametrize("splits", [1, 4, 17, 400])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_by_byte_ranges_equals_the_plain_reader(spark, tmpdir_path, splits, end):
    p = os.path.join(tmpdir_path, "odd.csv")
    body = ("id,TEXT,p,q\n" + "\n".join(ODD_CSV)).replace("\n", end)  # no line end behind the last record
    with open(p, "wb") as f:
        f.write(body.encode("mac_roman"))
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    plain = (spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
             .option("encoding", "x-MacRoman").option("mode", "FAILFAST").csv(p))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        want = sorted(map(tuple, plain.collect()), key=repr)
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(-(-os.path.getsize(p) // splits)))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        lines = spark.read.option("lineSep", "\n").text(p)
        assert lines.rdd.getNumPartitions() >= min(splits, 8)
        got = sorted(map(tuple, C.read_corpus_csv(spark, p).collect()), key=repr)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want and len(want) == len(ODD_CSV) - 1


def test_csv_of_several_files_and_a_schema(spark, tmpdir_path):
    for i in range(3):
        _write_csv(os.path.join(tmpdir_path, f"part{i}.csv"), [f'a{i},"text\n{i}",y,n,y,n,x'])
    schema = C.corpus_schema(extra=["#AUTHID"])
    got = C.read_corpus_csv(spark, tmpdir_path, schema)
    assert sorted((r["#AUTHID"], r["TEXT"]) for r in got.collect()) == [(f"a{i}", f"text\n{i}") for i in range(3)] and got.schema == schema
    with pytest.raises(ValueError):
        C.read_corpus_csv(spark, tmpdir_path, C.corpus_schema(extra=["OTHER"]))


def test_missing_text_column_raises(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "bad.csv")
    _write_csv(p, ["a1,y"], header="#AUTHID,cEXT")
    with pytest.raises(ValueError, match="TEXT"):
        C.load_dataset(spark, p)


def test_json_sink_round_trip(spark, tmpdir_path):
    df = spark.createDataFrame([(1, 1.0, None)], "doc_id long, quality double, toxic double")
    out = os.path.join(tmpdir_path, "answers")
    K.write_answers_json(df, out)
    back = spark.read.schema(df.schema).json(out).collect()
    assert back[0]["doc_id"] == 1 and back[0]["toxic"] is None


def _newton(X, y, C=1.0, iters=50):
    Xb = np.hstack([X, np.ones((len(X), 1))])
    w = np.zeros(Xb.shape[1])
    reg = np.ones(Xb.shape[1]) / C
    reg[-1] = 0.0
    for _ in range(iters):
        p = 1 / (1 + np.exp(-Xb @ w))
        g = Xb.T @ (p - y) + reg * w
        H = Xb.T @ (Xb * (p * (1 - p))[:, None]) + np.diag(reg)
        w -= np.linalg.solve(H, g)
    return w


def test_logreg_matches_c1_optimum(spark, tmpdir_path):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(300, 4))
    y = (X @ np.array([1.0, -2.0, 0.5, 0.0]) + rng.normal(size=300) > 0).astype(float)
    from pyspark.ml.functions import array_to_vector
    df = spark.createDataFrame([(i, [float(v) for v in X[i]], float(y[i])) for i in range(300)],
                               "doc_id long, f array<double>, t double").select(
        "doc_id", array_to_vector("f").alias("features"), "t")
    models = M.fit_per_label(df, ["t"], C=1.0)
    w = _newton(X, y)
    m = models["t"]
    assert np.allclose(m.coefficients.toArray(), w[:-1], atol=1e-4) and abs(m.intercept - w[-1]) < 1e-4
    M.save_models(models, os.path.join(tmpdir_path, "m"))
    back = M.load_models(os.path.join(tmpdir_path, "m"), ["t"])
    assert np.allclose(back["t"].coefficients.toArray(), m.coefficients.toArray())
    pred = M.predict_per_label(models, df).collect()
    acc = np.mean([r["t"] == y[r["doc_id"]] for r in pred])
    assert acc > 0.8


def test_bucketed_join_has_no_shuffle(spark, tmpdir_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
        labs = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
        d = C.save_bucketed(docs, "tl_docs", buckets=4, path=os.path.join(tmpdir_path, "d"))
        lb = C.save_bucketed(labs, "tl_labels", buckets=4, path=os.path.join(tmpdir_path, "l"))
        j = d.join(lb, "doc_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert j.count() == labs.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


BOW = [(1, ["a", "b", "b"], 1), (2, ["a"], 0), (3, ["b", "c"], 1), (4, ["a", "a"], 0), (5, [], 1), (6, None, 0)]


def _dense(n_terms, blocks):
    """Labels and the matrix of all blocks, in any order of rows."""
    rows = []
    for b in blocks.collect():
        lengths, terms, vals = np.frombuffer(b["lengths"], np.int32), np.frombuffer(b["terms"], np.int32), np.frombuffer(b["vals"])
        x, at = np.zeros((b["n"], n_terms)), 0
        for i, n in enumerate(lengths):
            x[i, terms[at:at + n]] = vals[at:at + n]
            at += n
        rows += [(*y, *r) for y, r in zip(np.frombuffer(b["y"]).reshape(b["n"], -1), x)]
    return sorted(rows)


def test_term_blocks_are_counts_over_population_std(spark):
    df = spark.createDataFrame(BOW, "doc_id long, tokens array<string>, t int")
    terms = TM.fit_terms(df, len(BOW))
    assert [(r["token"], r["idx"]) for r in terms.orderBy("idx").collect()] == [("a", 0), ("b", 1), ("c", 2)]
    counts = np.array([[(tokens or []).count(w) for w in "abc"] for _, tokens, _ in BOW], dtype=float)
    want = counts / np.where(counts.std(axis=0) > 0, counts.std(axis=0), 1)
    got = _dense(3, TM.term_blocks(df, terms, ["t"]))
    assert np.allclose(got, sorted((y, *r) for (_, _, y), r in zip(BOW, want)))
    unseen = spark.createDataFrame([(7, ["zzz", "a"], 1)], df.schema)
    assert np.allclose(_dense(3, TM.term_blocks(unseen, terms, ["t"])), [(1, 1 / counts.std(axis=0)[0], 0, 0)])


def _some_texts(spark, n=400):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(["common"] * 50 + list(rng.choice(words, rng.integers(0, 20))))) for i in range(n)]
    return spark.createDataFrame([(i, t, int("w1 " in t), int(len(t) > 400)) for i, t in rows], "doc_id long, text string, p int, q int")


def test_bag_of_words_fits_reach_the_newton_optimum_together(spark, monkeypatch):
    from textlabel.operators import linear as LN
    df = _some_texts(spark).withColumn("tokens", TX.bow_tokens("text"))
    passes, one = [], LN._pass
    monkeypatch.setattr(LN, "_pass", lambda *a: passes.append(len(a[3])) or one(*a))
    monkeypatch.setattr(LN, "OUTWEIGH", 1)
    monkeypatch.setattr(LN, "LEAST", 1000)  # several partitions: sums are reduced slice by slice
    monkeypatch.setattr(LN, "SLICE", 16)
    model = M.fit_bag_of_words(df, ["p", "q"], tol=1e-8)
    assert passes[0] == 2 and len(passes) < sum(f.steps for f in model.fits.values()) * 1.2 + 10  # both labels in one pass
    table = {r["token"]: r for r in model.weights.collect()}
    rows = df.orderBy("doc_id").collect()
    names = sorted(table)
    X = np.array([[r["tokens"].count(t) / table[t]["scale"] for t in names] for r in rows])
    for j, label in enumerate(["p", "q"]):
        w = _newton(X, np.array([r[label] for r in rows], float))
        assert np.allclose([table[t]["w"][j] for t in names], w[:-1], atol=1e-4) and abs(model.fits[label].intercept - w[-1]) < 1e-3
    want = 1 / (1 + np.exp(-(X @ np.array([table[t]["w"][0] for t in names]) + model.fits["p"].intercept)))
    got = {r["doc_id"]: r for r in model.transform(df.drop("tokens")).collect()}
    assert np.allclose([got[r["doc_id"]]["p__p1"] for r in rows], want) and all(got[r["doc_id"]]["p"] == (x > 0.5) for r, x in zip(rows, want))


def test_wide_fit_is_the_dense_fit_and_sends_vectors_over_the_rows_only(spark, monkeypatch):
    """50,000 features of 60 rows: no vector of the features' length comes to the driver or leaves it."""
    from textlabel.operators import linear as LN
    rng = np.random.default_rng(5)
    rows = [(i, [f"t{i}_{k}" for k in range(830)] + ["a"] * int(rng.integers(0, 4)) + ["b"] * int(rng.integers(0, 3)), int(rng.integers(0, 2))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>, t int").repartition(4, "doc_id")
    terms = TM.fit_terms(df, len(rows)).checkpoint(eager=True)
    n = terms.count()
    blocks = TM.term_blocks(df, terms, ["t"])
    want, = LN.fit(blocks, n, [LN.Problem(0, 1 / 60)], 1e-8)
    sent, one = [], LN._pass
    monkeypatch.setattr(LN, "_pass", lambda *a: (lambda sums: sent.append(len(sums)) or sums)(one(*a)))
    monkeypatch.setattr(LN, "LEAST", 1000)  # several partitions
    (got,), table = LN.fit_wide(blocks, n, [LN.Problem(0, 1 / 60)], 1e-8)
    w = np.zeros(n)
    for r in table.collect():
        w[r["idx"]] = r["w"][0]
    assert table.count() == n > 49_000 and got.converged and max(sent) < 1000
    assert np.allclose(w, want.weights, atol=1e-6) and abs(got.intercept - want.intercept) < 1e-6 and abs(got.loss - want.loss) < 1e-9


def test_wide_fit_is_the_same_with_vectors_in_files(spark, monkeypatch):
    """More rows than the driver has memory for: files, read by slices, and one problem at a time."""
    from textlabel.operators import linear as LN
    rng = np.random.default_rng(6)
    rows = [(i, [f"w{int(v)}" for v in rng.integers(0, 40, 30)], int(rng.integers(0, 2)), int(rng.integers(0, 3) > 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>, t int, u int").repartition(4, "doc_id")
    terms = TM.fit_terms(df, len(rows)).checkpoint(eager=True)
    blocks = TM.term_blocks(df, terms, ["t", "u"])
    problems = [LN.Problem(0, 0.01), LN.Problem(1, 0.02, 2.0)]
    want, table = LN.fit_wide(blocks, terms.count(), problems, 1e-4)
    weights = {r["idx"]: r["w"] for r in table.collect()}
    rooms, one = [], LN._room
    monkeypatch.setattr(LN, "_room", lambda n, in_files: (lambda v: rooms.append(type(v)) or v)(one(n, in_files)))
    for name, value in (("IN_MEMORY", 0), ("HELD", 2000), ("CUT", 77)):
        monkeypatch.setattr(LN, name, value)
    got, table = LN.fit_wide(blocks, terms.count(), problems, 1e-4)
    assert set(rooms) == {np.memmap} and all(f.converged for f in got)
    assert all(abs(f.loss - g.loss) < 1e-5 and abs(f.intercept - g.intercept) < 0.05 for f, g in zip(want, got))
    assert all(np.allclose(r["w"], weights[r["idx"]], atol=1e-2) for r in table.collect())


def test_bag_of_words_is_fitted_on_all_rows(spark, monkeypatch):
    """No sample, whatever the number of rows."""
    import inspect
    df = _some_texts(spark, 200).withColumn("tokens", TX.bow_tokens("text"))
    monkeypatch.setattr(M, "sample_rows", lambda df, *a, **kw: df.limit(50))
    fitted, one = [], M.fit_wide
    monkeypatch.setattr(M, "fit_wide", lambda blocks, *a: fitted.append(blocks.agg(F.sum("n").alias("n")).first()["n"]) or one(blocks, *a))
    model = M.fit_bag_of_words(df, ["p"])
    assert fitted == [200] and model.n_terms == df.select(F.explode("tokens")).distinct().count()
    assert "fit_rows" not in inspect.signature(M.fit_bag_of_words).parameters


def test_saved_model_scores_raw_text_in_a_fresh_session(spark, tmpdir_path):
    df = _some_texts(spark, 120)
    model = M.fit_bag_of_words(df.withColumn("tokens", TX.bow_tokens("text")), ["p", "q"])
    model.write().overwrite().save(os.path.join(tmpdir_path, "model"))
    new = [(1, "common w1 w2"), (2, None), (3, ""), (4, "never seen")]
    want = sorted(map(tuple, model.transform(spark.createDataFrame(new, "doc_id long, text string")).collect()))
    code = f"""
import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from textlabel.session import get_spark
from textlabel.operators.models import BagOfWordsModel
spark = get_spark("local[2]", 2)
m = BagOfWordsModel.load({os.path.join(tmpdir_path, "model")!r})
print("ROWS", sorted(map(tuple, m.transform(spark.createDataFrame({new!r}, "doc_id long, text string")).collect())))
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180)
    assert f"ROWS {want}" in done.stdout, done.stderr[-2000:]


def test_fit_rows_bounds_the_rows_whatever_their_keys(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"))
    kept = M.sample_rows(df, "doc_id", 500)
    assert 400 < kept.count() < 600
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, M.sample_rows(df.repartition(9), "doc_id", 500).collect()))


def test_random_search_runs_all_trials_in_one_fit(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(300)]
    df = spark.createDataFrame([(i, x, int(x[0] > 0), int(x[1] + x[2] > 0)) for i, x in rows], "doc_id long, features array<double>, a int, b int")
    out = M.random_search(df.filter("doc_id < 200"), df.filter("doc_id >= 200"), ["a", "b"], n_trials=3).collect()
    assert len(out) == 3 and sum(r["is_best"] for r in out) == 1 and all(r["gradient"] <= 1e-4 for r in out)
    assert min(out, key=lambda r: (r["val_loss"], r["trial"]))["is_best"]
    assert [t["reg_param"] for t in M.search_trials(spark, 3)] == [r["reg_param"] for r in sorted(out, key=lambda r: r["trial"])]


@pytest.mark.parametrize("search", [False, True])
def test_embeddings_are_made_once(spark, search):
    """The split, the fit and the scores read stored embeddings."""
    from textlabel.plans import pipelines
    rng = np.random.default_rng(1)
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = [(i, [float(v) for v in rng.normal(size=3)], int(rng.integers(0, 2))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, embedding array<double>, a int")
    emb = df.select("doc_id", "embedding").mapInArrow(count, "doc_id long, embedding array<double>")
    out = (pipelines.embedding_search if search else pipelines.embedding_classifier)(emb, df.select("doc_id", "a"), ["a"])
    assert out.count() and made.value == 200


def test_bow_counts_use_training_vocabulary_only(spark):
    from textlabel.operators import features as FE
    df = spark.createDataFrame([(1, "train", ["a", "b", "a"]), (2, "test", ["b", "c"])],
                               "doc_id long, split string, tokens array<string>")
    got = {(r["doc_id"], r["token"]): r["tf"] for r in FE.bow_counts_fitted(df).collect()}
    assert got == {(1, "a"): 2, (1, "b"): 1, (2, "b"): 1}
