"""Batch inference through a user predictor (ML4) with retries (ML5).

``predictor_factory`` is called once per task (not per row) and returns an object with
``answer(key, prompt) -> str``, or ``answer_batch(keys, prompts) -> list[str]`` (one call per
Arrow batch), or is a plain callable taking one prompt. It must return only the newly
generated text: a generator that echoes the prompt would let the first '{' of an example's
label block be parsed as the answer. Rows carry ``status`` and ``attempts``: a task that is retried
after a lost executor calls the service again, so answers should be written once and parsed
from the stored table.
"""

from __future__ import annotations

import random
import time
from typing import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def call_with_retry(fn: Callable[[], str], max_attempts: int = 10, wait_min: float = 1.0,
                    wait_max: float = 60.0, rng: random.Random | None = None):
    """ML5: random exponential back-off; returns (answer or None, status, attempts)."""
    rng = rng or random.Random()
    for attempt in range(1, max_attempts + 1):
        try:
            return fn(), "ok", attempt
        except Exception:  # noqa: BLE001 - any predictor failure is retried
            if attempt == max_attempts:
                return None, "failed", attempt
            if wait_max > 0:
                # random exponential back-off: uniform between min and min(max, 2^attempt)
                high = max(wait_min, min(wait_max, 2.0 ** attempt))
                time.sleep(rng.uniform(wait_min, high))
    return None, "failed", max_attempts


def batch_infer(prompts: DataFrame, predictor_factory: Callable, key: str = "doc_id",
                prompt: str | list[str] = "prompt", max_attempts: int = 10, wait_min: float = 1.0,
                wait_max: float = 60.0, passthrough: list[str] | None = None, at_once: int = 256) -> DataFrame:
    """ML4: (passthrough, key, raw, status, attempts) by ``mapInPandas`` over Arrow batches; the key keeps its name and type.

    ``prompt``: the input column, or several (also arrays, e.g. ids and mask), which reach the predictor as one tuple for each
    row. A null input is passed through as ``status='no_prompt'``. A batch predictor gets at most ``at_once`` inputs a call; if the call
    fails or gives another number of answers than it was asked for, its rows are asked one by one, so that one bad
    input costs only its own answer (``failed``)."""
    passthrough = passthrough or []
    columns = [prompt] if isinstance(prompt, str) else list(prompt)
    src = prompts.select(*passthrough, key, *columns)
    fields = [src.schema[c] for c in [*passthrough, key]]
    schema = T.StructType([*fields, T.StructField("raw", T.StringType()), T.StructField("status", T.StringType()),
                           T.StructField("attempts", T.IntegerType())])

    def run(batches):
        predictor = predictor_factory()
        rng = random.Random()
        whole = hasattr(predictor, "answer_batch")

        def ask(keys, inputs):
            answers = list(predictor.answer_batch(keys, inputs))
            if len(answers) != len(inputs):
                raise ValueError(f"{len(answers)} answers to {len(inputs)} inputs")
            return answers

        def one(k, p):
            fn = (lambda: ask([k], [p])[0]) if whole else (lambda: _ask(predictor, k, p))
            return call_with_retry(fn, max_attempts, wait_min, wait_max, rng)

        for pdf in batches:
            keys = pdf[key].tolist()
            inputs = [None if any(v is None or v is pd.NA or (isinstance(v, float) and v != v) for v in vs) else (vs if len(columns) > 1 else vs[0])
                      for vs in zip(*(pdf[c] for c in columns))]
            todo = [i for i, p in enumerate(inputs) if p is not None]
            results: list = [(None, "no_prompt", 0)] * len(keys)
            for start in range(0, len(todo), at_once):
                part = todo[start: start + at_once]
                got, status, n = (call_with_retry(lambda: ask([keys[i] for i in part], [inputs[i] for i in part]), max_attempts, wait_min, wait_max, rng)
                                  if whole else (None, "failed", 0))
                for j, i in enumerate(part):
                    if status == "ok":
                        results[i] = (got[j], "ok", n)
                    else:
                        answer, its_status, its_n = one(keys[i], inputs[i])
                        results[i] = (answer, its_status, n + its_n)
            raw, status, attempts = zip(*results) if results else ((), (), ())
            out = {c: pdf[c] for c in [*passthrough, key]}
            out |= {"raw": list(raw), "status": list(status), "attempts": pd.Series(attempts, dtype="int32").values}
            yield pd.DataFrame(out)

    return src.mapInPandas(run, schema)


def _ask(predictor, key, prompt):
    if hasattr(predictor, "answer"):
        return predictor.answer(key, prompt)
    return predictor(prompt)
