"""End-to-end pipelines (survey section 3): bag of words (3.1), sequence features (3.2),
prompt experiment (3.3), and the embedding classifier / search re-aimed from the neural
models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import text as T
from ..operators import answers as A
from ..operators import evaluate as E
from ..operators import models as M
from ..operators import prompts as PR
from ..operators import sampling as S
from ..operators.inference import batch_infer
from ..operators.ranking import md5_key
from ..session import ensure_checkpoint_dir


def bag_of_words_model(df: DataFrame, label_cols: list[str], test_size: float = 0.2, seed: int = 42, key: str = "doc_id", **fit_kw):
    """3.1 up to the fits: lenient labels, exact split, dictionary and scales of the training rows, one regression per label in shared
    scans. Returns (model, test rows with their tokens)."""
    lab = df.select(key, "text", *[L.encode_lenient(c).alias(c) for c in label_cols])
    sp = S.train_test_split(lab, key, seed, test_size).withColumn("tokens", T.bow_tokens("text")).drop("text")
    ensure_checkpoint_dir(df.sparkSession)
    sp = sp.checkpoint(eager=True)  # split + tokens are read by the dictionary, the blocks and the test
    model = M.fit_bag_of_words(sp.filter(F.col("split") == "train"), label_cols, key, **fit_kw)
    return model, sp.filter(F.col("split") == "test")


def bag_of_words(df: DataFrame, label_cols: list[str], key: str = "doc_id", **kw) -> DataFrame:
    """ML2: accuracy per label and overall (plus precision / recall) on the test split."""
    model, test = bag_of_words_model(df, label_cols, key=key, **kw)
    return M.evaluate_predictions(model.scored(test), test.select(key, *label_cols), label_cols, key)


def embedding_classifier(emb: DataFrame, actual: DataFrame, label_cols: list[str],
                         test_size: float = 0.2, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """ML3: document embeddings -> one logistic regression per label -> test metrics."""
    ensure_checkpoint_dir(emb.sparkSession)
    # stored once: the split reads the keys several times, each time the embeddings would be made anew
    data = emb.select(key, F.col("embedding").alias("features")).join(actual, key).checkpoint(eager=True)
    sp = S.train_test_split(data, key, seed, test_size).checkpoint(eager=True)
    train = sp.filter(F.col("split") == "train")
    test = sp.filter(F.col("split") == "test")
    models = M.fit_per_label(train, label_cols)
    return M.evaluate_models(models, test, test.select(key, *label_cols), label_cols)


def embedding_search(emb: DataFrame, actual: DataFrame, label_cols: list[str], n_trials: int = 4,
                     seed: int = 42, key: str = "doc_id") -> DataFrame:
    """ML6 on the embedding features: train / val from the exact split."""
    ensure_checkpoint_dir(emb.sparkSession)
    # stored once: the split reads the keys several times, each time the embeddings would be made anew
    data = emb.select(key, F.col("embedding").alias("features")).join(actual, key).checkpoint(eager=True)
    sp = S.exact_split(data, key, seed, rule="fixed").checkpoint(eager=True)
    return M.random_search(sp.filter(F.col("split") == "train"), sp.filter(F.col("split") == "val"),
                           label_cols, n_trials=n_trials, seed=seed, key=key)


def experiment_ledger(df: DataFrame, traits, label_cols: list[str], answerer, frac: float = 0.001, runs: int = 1, example_count: int = 1,
                      budget: int | None = PR.DEFAULT_BUDGET, style: str = "chat", cut: str = "greedy", key: str = "doc_id") -> DataFrame:
    """3.3, AG18: the fate of every sampled row in every run, stored: (run, key, fate, <label> as answered, actual__<label>).

    Exact seeded sample; per run r the k examples drawn with seed r; prompts for every (run, row) in the chat or the rules form;
    ``answerer(prompts)`` gives (run, key, raw, status, attempts); answers are cut (greedy or split), parsed and joined by key. A row's fate
    is ``no_prompt`` (over budget or no text), ``failed`` (no answer), ``unparsed`` or ``kept``; no row is left out."""
    ensure_checkpoint_dir(df.sparkSession)
    # stored once: every run's examples, the prompts and the actual labels read it
    sample = S.sample_fraction(df.select(key, "text", *label_cols), frac, key, seed=42).checkpoint(eager=True)
    if example_count > 0:
        ex = None
        for r in range(runs):
            one = (S.sample_examples(sample, example_count, key, seed=r)
                   .withColumn("run", F.lit(r)).withColumn("_order", md5_key(r, key)))
            ex = one if ex is None else ex.unionByName(one)
        prompts = PR.few_shot_prompts(sample, ex, traits, label_cols, key=key, budget=budget, style=style, by=["run"])
    else:
        prompts = PR.zero_shot_prompts(sample, traits, key=key).crossJoin(
            sample.sparkSession.range(runs).select(F.col("id").cast("int").alias("run")))
    # stored once: a recomputation (or a lost executor) must not ask again
    parsed = A.parse_answers(answerer(prompts.select("run", key, "prompt")).checkpoint(eager=True), label_cols, cut=cut)
    fate = (F.when(F.col("status") == "no_prompt", "no_prompt").when(F.col("status") != "ok", "failed")
            .when(F.col("parse_ok"), "kept").otherwise("unparsed"))
    actual = sample.select(key, *[L.encode_lenient(c).alias(f"actual__{c}") for c in label_cols])
    return parsed.select("run", key, fate.alias("fate"), *label_cols).join(actual, key).checkpoint(eager=True)


def experiment_metrics(ledger: DataFrame, label_cols: list[str], key: str = "doc_id") -> DataFrame:
    """Per-run metrics of the kept rows, averaged over the runs."""
    cells = [F.struct(F.lit(c).alias("trait"), F.col(f"actual__{c}").cast("double").alias("actual"), F.col(c).alias("predicted")) for c in label_cols]
    return E.run_average_metrics(E.metric_table(ledger.filter("fate = 'kept'").select("run", key, F.explode(F.array(*cells)).alias("c")).select("run", key, "c.*")))


def experiment_fates(ledger: DataFrame) -> DataFrame:
    """AG18: (run, fate, n, share) of all sampled rows; the counts of a run add up to the sample."""
    counts = ledger.groupBy("run", "fate").agg(F.count(F.lit(1)).alias("n"))
    total = ledger.groupBy("run").agg(F.count(F.lit(1)).alias("total"))
    return counts.join(total, "run").select("run", "fate", "n", (F.col("n") / F.col("total")).alias("share"))


def missed_rows(ledger: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows without a usable answer, by run, with the cause."""
    return ledger.filter("fate <> 'kept'").select("run", key, "fate")


def prompt_experiment(df: DataFrame, traits, label_cols: list[str], predictor_factory=None, frac: float = 0.001, runs: int = 1,
                      example_count: int = 1, budget: int | None = PR.DEFAULT_BUDGET, key: str = "doc_id", answerer=None,
                      style: str = "chat", cut: str = "greedy", **infer_kw) -> DataFrame:
    """3.3 / ML7: the metrics of an experiment whose prompts go to a predictor, or to any ``answerer``."""
    answerer = answerer or (lambda prompts: batch_infer(prompts, predictor_factory, key=key, passthrough=["run"], **infer_kw))
    return experiment_metrics(experiment_ledger(df, traits, label_cols, answerer, frac, runs, example_count, budget, style, cut, key), label_cols, key)
