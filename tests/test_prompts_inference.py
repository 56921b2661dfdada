"""Prompt layout, budget flag, chat messages, and batch inference with retries."""

import json

import pytest

from pyspark.sql import functions as F

from textlabel.operators import prompts as PR
from stubs import Counted, RuleStub
from textlabel.operators.inference import batch_infer, call_with_retry

TRAITS2 = [("Quality", "quality"), ("Toxicity", "toxic")]


def test_chat_header_reference_wording():
    h = PR.chat_header(PR.REFERENCE_TRAITS)
    assert h.startswith("\n    Analyze the following text and determine if the author exhibits the following traits: "
                        "Extraversion (cEXT), Neuroticism (cNEU), Agreeableness (cAGR), Conscientiousness (cCON), Openness (cOPN).\n")
    assert "Use cEXT, cNEU, cAGR, cCON and cOPN to represent each trait.\n" in h
    assert h.endswith("Return only results in JSON format without indicating it is JSON file. \n    ")


def test_rules_header_lines():
    h = PR.rules_header(TRAITS2)
    assert '        "quality": 0,  # 1 if Quality is exhibited, 0 if not\n' in h
    assert '        "toxic": 0   # 1 if Toxicity is exhibited, 0 if not\n    ' in h


def _frame(spark):
    return spark.createDataFrame([(1, "first essay", "y", "n"), (2, "second one", "n", "y"), (3, "third", "y", "y")],
                                 "doc_id long, text string, quality string, toxic string")


def test_few_shot_layout_and_budget(spark):
    df = _frame(spark)
    ex = df.filter("doc_id = 2")
    out = {r["doc_id"]: r for r in PR.few_shot_prompts(df, ex, TRAITS2, ["quality", "toxic"], budget=10_000).collect()}
    want_ex = ('\n        Example:\n        "second one"\n\n        {\n            "quality": 0,\n'
               '            "toxic": 1  \n        }\n        ')
    assert out[1]["prompt"] == PR.chat_header(TRAITS2) + want_ex + "\n    Analyze the essay:\n    first essay\n    "
    assert not out[1]["over_budget"]
    tight = {r["doc_id"]: r for r in PR.few_shot_prompts(df, ex, TRAITS2, ["quality", "toxic"], budget=40).collect()}
    assert tight[1]["prompt"] is None and tight[1]["over_budget"]
    # zero examples never overflow
    zero = PR.few_shot_prompts(df, ex.filter("false"), TRAITS2, ["quality", "toxic"], budget=1).collect()
    assert all(not r["over_budget"] and r["prompt"] for r in zero)


def test_examples_per_run(spark):
    df = _frame(spark)
    ex = df.filter("doc_id < 3").withColumn("run", F.col("doc_id") - 1)
    got = PR.few_shot_prompts(df, ex, TRAITS2, ["quality", "toxic"], by=["run"]).collect()
    assert len(got) == 6 and {r["run"] for r in got} == {0, 1}


def test_chat_messages_json(spark):
    df = spark.createDataFrame([(1, 'say "hi"\n')], "doc_id long, prompt string")
    msgs = json.loads(PR.chat_messages(df).first()["messages"])
    assert msgs == [{"role": "system", "content": PR.SYSTEM_MESSAGE}, {"role": "user", "content": 'say "hi"\n'}]


def test_retry_counts():
    calls = {"n": 0}

    def twice():
        calls["n"] += 1
        if calls["n"] <= 2:
            raise RuntimeError("busy")
        return "ok"
    assert call_with_retry(twice, max_attempts=5, wait_min=0, wait_max=0) == ("ok", "ok", 3)

    def never():
        raise RuntimeError("down")
    assert call_with_retry(never, max_attempts=4, wait_min=0, wait_max=0) == (None, "failed", 4)


def test_batch_infer_stub(spark):
    prompts = spark.createDataFrame([(i, "p" * (1990 + i)) for i in range(30)] + [(99, None)], "doc_id long, prompt string")
    rows = {r["doc_id"]: r for r in batch_infer(prompts, RuleStub, max_attempts=3, wait_min=0, wait_max=0).collect()}
    assert rows[26]["status"] == "failed" and rows[26]["attempts"] == 3 and rows[26]["raw"] is None
    assert rows[22]["status"] == "ok" and rows[22]["attempts"] == 2
    assert rows[3]["raw"] == '{"quality": 0, "toxic": 0}'
    assert rows[99]["status"] == "no_prompt"


def test_exclude_self(spark):
    df = _frame(spark)
    ex = df.filter("doc_id in (1, 2)")
    got = {r["doc_id"]: r["prompt"] for r in PR.few_shot_prompts(df, ex, TRAITS2, ["quality", "toxic"],
                                                                 exclude_self=True).collect()}
    assert '"first essay"' not in got[1] and '"second one"' in got[1]
    assert '"first essay"' in got[3] and '"second one"' in got[3]


def test_prompt_experiment_calls_predictor_once_per_row(spark):
    from textlabel.plans import inputs as I
    from textlabel.plans.pipelines import prompt_experiment
    calls = spark.sparkContext.accumulator(0)

    class Counting:
        def answer(self, key, prompt):
            calls.add(1)
            return '{"quality": 1, "toxic": 0}'

    lab = I.labelled_yn(spark, "/root/testdata/sf0.001")
    n = lab.count()
    out = prompt_experiment(lab, I.TRAITS, I.LABELS, Counting, frac=0.5, runs=2, example_count=1,
                            max_attempts=1, wait_min=0, wait_max=0)
    rows = {(r["metric"], r["trait"]): r["value"] for r in out.collect()}
    assert calls.value == 2 * round(0.5 * n)
    assert rows[("recall", "quality")] == 1.0 and rows[("precision", "toxic")] == 0.0


def test_pluggable_token_counter(spark):
    import pandas as pd
    from pyspark.sql.types import IntegerType

    @F.pandas_udf(IntegerType())
    def words(s: pd.Series) -> pd.Series:
        return s.str.split().str.len()

    df = _frame(spark)
    ex = df.filter("doc_id = 2")
    rows = {r["doc_id"]: r for r in PR.few_shot_prompts(df, ex, TRAITS2, ["quality", "toxic"], budget=10_000,
                                                         token_counter=words).collect()}
    native = {r["doc_id"]: r for r in PR.few_shot_prompts(df, ex, TRAITS2, ["quality", "toxic"], budget=10_000).collect()}
    assert rows[1]["n_tokens"] == len(native[1]["prompt"].split())


def test_batch_predictor(spark):
    class Batch:
        def answer_batch(self, keys, prompts):
            return [f'{{"n": {len(p)}}}' for p in prompts]

    prompts = spark.createDataFrame([(1, "ab"), (2, None), (3, "abcd")], "doc_id long, prompt string")
    rows = {r["doc_id"]: r for r in batch_infer(prompts, Batch, wait_min=0, wait_max=0).collect()}
    assert rows[1]["raw"] == '{"n": 2}' and rows[3]["raw"] == '{"n": 4}'
    assert rows[2]["status"] == "no_prompt" and rows[1]["attempts"] == 1


def test_ledger_goes_on_after_a_killed_task(spark, tmp_path):
    from collections import Counter

    from textlabel.operators import ledger as LG
    rows = [(i, "x" * i) for i in range(1, 200)] + [(5, "xxxxx"), (300, None), (None, "null key")]
    prompts = spark.createDataFrame(rows, "doc_id long, prompt string")
    store, folder = f"{tmp_path}/store", str(tmp_path)
    ask = lambda df: LG.answer_all(df, lambda: Counted(folder), store, chunk_rows=20, max_attempts=1, wait_min=0, wait_max=0)
    with pytest.raises(Exception):
        ask(prompts)  # a local task is not tried again: the job fails with the task
    first = Counter(open(f"{folder}/asked").read().split())
    got = {(r["doc_id"], r["raw"], r["status"]) for r in ask(prompts).collect()}
    assert got == {(k, None if p is None else str(len(p)), "no_prompt" if p is None else "ok") for k, p in rows}
    calls = Counter(open(f"{folder}/asked").read().split())
    again = [k for k, n in calls.items() if n > 1]
    kept = LG.answers_in(spark, store).count()
    assert kept == 201 and len(first) > 0 and len(again) <= 8 * 20  # at most the questions of the tasks under way
    ask(prompts.union(spark.createDataFrame([(400, "new")], "doc_id long, prompt string"))).collect()
    later = Counter(open(f"{folder}/asked").read().split())
    assert later - calls == Counter({"400": 1})


def test_ledger_asks_failed_rows_again(spark, tmp_path):
    from textlabel.operators import ledger as LG

    class Flaky:
        def answer(self, key, prompt):
            import os
            mark = f"{tmp_path}/m{key}"
            if key % 2 and not os.path.exists(mark):
                open(mark, "w").close()
                raise RuntimeError("busy")
            return "fine"

    prompts = spark.createDataFrame([(i, "p") for i in range(10)], "doc_id long, prompt string")
    got = LG.answer_all(prompts, Flaky, f"{tmp_path}/store", max_attempts=1, wait_min=0, wait_max=0).collect()
    assert len(got) == 10 and all(r["status"] == "ok" and r["attempts"] == 1 + r["doc_id"] % 2 for r in got)


def test_fates_add_up_to_the_sample(spark):
    from textlabel.plans import queries as Q
    fates = Q.experiment_fates(spark, "/root/testdata/sf0.001").collect()
    totals = {}
    for r in fates:
        totals[r["run"]] = totals.get(r["run"], 0) + r["n"]
    n = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").count()
    assert set(totals.values()) == {round(0.5 * n)} and {r["fate"] for r in fates} <= {"no_prompt", "failed", "unparsed", "kept"}
