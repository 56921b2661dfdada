"""Label models (ML1, ML2, ML3 fit, ML6, SNK2): one L2 logistic regression per label, all from one scan.

scikit-learn's ``C`` is ``reg = 1 / (C * n_train)`` of the mean loss, without standardisation: the same optimum. The fits share the
scans of ``operators.linear``; ``BagOfWordsModel`` is the whole path from raw text to predictions (tokens, dictionary with scales,
weights) as a Spark ML stage that is saved and loaded.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.labels import sigmoid
from . import terms as TM
from .evaluate import long_cells, metric_table
from .linear import Fit, Problem, dense_blocks, fit, fit_wide
from .ranking import md5_key, md5_unit


@dataclass
class LabelModel:
    """One label's regression."""

    coefficients: DenseVector
    intercept: float
    loss: float = 0.0
    gradient: float = 0.0
    steps: int = 0
    converged: bool = True

    @staticmethod
    def of(found: Fit) -> "LabelModel":
        return LabelModel(DenseVector(found.weights), found.intercept, found.loss, found.gradient, found.steps, found.converged)


def fit_per_label(train: DataFrame, label_cols: list[str], features: str = "features", C: float = 1.0, n_train: int | None = None,
                  reg_param: float | None = None, max_iter: int = 1000, tol: float = 1e-7) -> dict[str, LabelModel]:
    """ML1 on dense features (array or vector): one logistic regression per label, fitted together."""
    blocks = dense_blocks(train, features, label_cols)
    n_train = n_train if n_train is not None else train.count()
    width = len(train.select(vector_or_array(train, features).alias("x")).first()["x"])
    reg = 1.0 / (C * max(n_train, 1)) if reg_param is None else reg_param
    found = fit(blocks, width, [Problem(j, reg) for j in range(len(label_cols))], tol, max_iter)
    return {c: LabelModel.of(f) for c, f in zip(label_cols, found)}


def vector_or_array(df: DataFrame, features: str):
    col = F.col(features)
    return col if df.schema[features].dataType.simpleString().startswith("array") else vector_to_array(col)


def predict_per_label(models: dict[str, LabelModel], df: DataFrame, key: str = "doc_id", features: str = "features") -> DataFrame:
    """Score every label; returns key, <label> (0/1 prediction), <label>__p1 (probability)."""
    x = vector_or_array(df, features)
    out = [key]
    for label, m in models.items():
        products = F.zip_with(x, F.lit([float(v) for v in m.coefficients.toArray()]), lambda a, b: a * b)
        p = sigmoid(F.aggregate(products, F.lit(float(m.intercept)), lambda a, b: a + b))
        out += [(p > 0.5).cast("int").alias(label), p.alias(f"{label}__p1")]
    return df.select(*out)


def evaluate_predictions(pred: DataFrame, actual: DataFrame, label_cols: list[str], key: str = "doc_id") -> DataFrame:
    """ML2 tail: accuracy / precision / recall per label and overall, long form."""
    cells = long_cells(actual, pred.withColumn("run", F.lit(0)).select(key, "run", *label_cols), label_cols, key, run="run")
    return metric_table(cells).drop("run")


def evaluate_models(models: dict[str, LabelModel], test: DataFrame, actual: DataFrame, label_cols: list[str], key: str = "doc_id") -> DataFrame:
    return evaluate_predictions(predict_per_label(models, test, key), actual, label_cols, key)


# ---- bag of words: raw text -> tokens -> terms -> margins -----------------------------------------

class BagOfWordsModel(Model, MLWritable, MLReadable):
    """The fitted path from raw text to one prediction per label: (token, scale, w) for every term of the training rows, and intercepts.

    ``transform`` adds <label> (0/1) and <label>__p1. Texts are tokenised as in training; words the training rows do not hold do not count.
    """

    def __init__(self, weights: DataFrame | None = None, fits: dict[str, LabelModel] | None = None, key: str = "doc_id", text: str = "text", n_terms: int = 0):
        super().__init__()
        self.weights, self.fits, self.key, self.text, self.n_terms = weights, fits or {}, key, text, n_terms

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.scored(df.withColumn("tokens", TX.bow_tokens(self.text)))

    def scored(self, df: DataFrame, tokens: str = "tokens") -> DataFrame:
        """key, <label>, <label>__p1 of rows that have their tokens already."""
        labels = list(self.fits)
        per_one = self.weights.select("token", F.transform("w", lambda x: x / F.col("scale")).alias("w"))
        margins = TM.term_scores(df, per_one, [self.fits[c].intercept for c in labels], self.key, tokens)
        out = [self.key]
        for j, label in enumerate(labels):
            p = sigmoid(F.col("margins")[j])
            out += [(p > 0.5).cast("int").alias(label), p.alias(f"{label}__p1")]
        return margins.select(*out)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: BagOfWordsModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        spark = m.weights.sparkSession
        m.weights.write.mode("overwrite").parquet(f"{path}/terms")
        meta = {"key": m.key, "text": m.text, "n_terms": m.n_terms,
                "labels": [{"label": c, "intercept": f.intercept, "loss": f.loss, "gradient": f.gradient, "steps": f.steps, "converged": f.converged} for c, f in m.fits.items()]}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


class _Reader(MLReader):
    def load(self, path: str) -> BagOfWordsModel:
        spark = SparkSession.getActiveSession()
        meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
        fits = {r["label"]: LabelModel(DenseVector([]), r["intercept"], r["loss"], r["gradient"], r["steps"], r["converged"]) for r in meta["labels"]}
        return BagOfWordsModel(spark.read.parquet(f"{path}/terms"), fits, meta["key"], meta["text"], meta["n_terms"])


def sample_rows(train: DataFrame, key: str, fit_rows: int, seed: int = 42) -> DataFrame:
    """At most about ``fit_rows`` rows, the same in every layout: rows whose md5 of (seed, key) is in the first ``fit_rows / n`` of the range.
    For callers that want a sample; no fit takes one."""
    n = train.count()
    if n <= fit_rows:
        return train
    return train.filter(md5_unit(md5_key(seed, key)) < F.lit(int(2 ** 32 * fit_rows / n)))


def fit_bag_of_words(train: DataFrame, label_cols: list[str], key: str = "doc_id", text: str = "text", C: float = 1.0,
                     tol: float = 1e-4, max_iter: int = 1000, tokens: str = "tokens") -> BagOfWordsModel:
    """ML2 fit: dictionary and scales of all training rows, their blocks, one regression per label in shared scans. ``train`` has the tokens."""
    n_rows = train.count()
    terms = TM.fit_terms(train, n_rows, tokens, key).checkpoint(eager=True)
    n_terms = terms.count()
    blocks = TM.term_blocks(train, terms, label_cols, tokens)
    found, w = fit_wide(blocks, n_terms, [Problem(j, 1.0 / (C * n_rows)) for j in range(len(label_cols))], tol, max_iter)
    none = F.array_repeat(F.lit(0.0), len(label_cols))  # of a term that is in no block
    weights = terms.join(w, "idx", "left").select("token", "idx", "scale", F.coalesce("w", none).alias("w")).checkpoint(eager=True)
    return BagOfWordsModel(weights, {c: LabelModel.of(f) for c, f in zip(label_cols, found)}, key, text, n_terms)


# ---- search -----------------------------------------------------------------------------------------

def search_trials(spark: SparkSession, n_trials: int, seed: int = 42) -> list[dict]:
    """ML6: the trials' parameters from md5 of (seed, trial, name), as SQL can state them: reg between 1e-4 and 1, the weight of positive rows
    1 or 2."""
    unit = lambda name: md5_unit(md5_key(seed, "id", F.lit(name))) / F.lit(4294967296.0)
    trials = spark.range(n_trials).select(F.col("id").alias("trial"), F.pow(F.lit(10.0), unit("reg") * 4 - 4).alias("reg_param"),
                                          F.when(unit("positive") < 0.5, 1.0).otherwise(2.0).alias("positive_weight"))
    return [r.asDict() for r in trials.orderBy("trial").collect()]


def random_search(train: DataFrame, val: DataFrame, label_cols: list[str], n_trials: int = 6, seed: int = 42, features: str = "features",
                  key: str = "doc_id", tol: float = 1e-4) -> DataFrame:
    """ML6: every trial and label is one problem of the same fit, so all of them read the rows together; scored by validation log loss. Returns
    the trial table with the best trial flagged (least loss, ties to the earlier trial)."""
    spark = train.sparkSession
    trials = search_trials(spark, n_trials, seed)
    width = len(train.select(vector_or_array(train, features).alias("x")).first()["x"])
    problems = [Problem(j, t["reg_param"], t["positive_weight"]) for t in trials for j in range(len(label_cols))]
    found = fit(dense_blocks(train, features, label_cols), width, problems, tol)
    models = {f"{t['trial']}:{c}": LabelModel.of(f) for (t, c), f in zip(((t, c) for t in trials for c in label_cols), found)}
    scored = predict_per_label(models, val.select(key, features, *label_cols), key, features)
    cell = [F.struct(F.lit(t["trial"]).alias("trial"), F.col(c).cast("double").alias("actual"), F.col(f"{t['trial']}:{c}__p1").alias("p")) for t in trials for c in label_cols]
    cells = scored.join(val.select(key, *label_cols), key).select(F.explode(F.array(*cell)).alias("c")).select("c.*")
    p = F.least(F.greatest(F.col("p"), F.lit(1e-15)), F.lit(1 - 1e-15))
    loss = -(F.col("actual") * F.log(p) + (1 - F.col("actual")) * F.log(1 - p))
    hit = ((F.col("p") >= 0.5).cast("double") == F.col("actual")).cast("double")
    table = cells.groupBy("trial").agg(F.avg(loss).alias("val_loss"), F.avg(hit).alias("val_acc"))
    worst = {t["trial"]: max(f.gradient for f in found[i * len(label_cols):(i + 1) * len(label_cols)]) for i, t in enumerate(trials)}
    given = spark.createDataFrame([(t["trial"], t["reg_param"], t["positive_weight"], worst[t["trial"]]) for t in trials],
                                  "trial long, reg_param double, positive_weight double, gradient double")
    out = given.join(table, "trial")
    best = out.agg(F.min_by("trial", F.struct("val_loss", "trial")).alias("best_trial"))
    return out.crossJoin(F.broadcast(best)).withColumn("is_best", F.col("trial") == F.col("best_trial")).drop("best_trial")  # one row


def save_models(models: dict[str, LabelModel], path: str, spark: SparkSession | None = None) -> None:
    """SNK2: the regressions on dense features as one table (label, intercept, coefficients)."""
    spark = spark or SparkSession.getActiveSession()
    rows = [(c, float(m.intercept), [float(v) for v in m.coefficients.toArray()]) for c, m in models.items()]
    spark.createDataFrame(rows, "label string, intercept double, coefficients array<double>").write.mode("overwrite").parquet(path)


def load_models(path: str, label_cols: list[str], spark: SparkSession | None = None) -> dict[str, LabelModel]:
    spark = spark or SparkSession.getActiveSession()
    found = {r["label"]: LabelModel(DenseVector(r["coefficients"]), r["intercept"]) for r in spark.read.parquet(path).collect()}  # a row a label
    return {c: found[c] for c in label_cols}
