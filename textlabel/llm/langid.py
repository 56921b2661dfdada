"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text's subwords are the 3- and 4-byte grams of its lower-cased words, word borders included, hashed to
``BUCKETS`` rows of an embedding table. Their average goes through a linear softmax. Table and softmax are
trained together by stochastic gradient descent in numpy on a bounded sample: about ``per_language`` documents of each
language. A fifth of the sample is held back to set the temperature of the softmax and the rejection limit.

For prediction the table times the softmax is one score per gram and language, so a text costs one lookup a gram.

``predict_language`` gives ``lang_pred``, ``score`` (the calibrated probability of it) and ``rejected``. A null text or one
without a letter is ``und`` with score 0 and rejected. With no language to learn every text is ``und``. Texts are read whole,
in slices of bounded size; rows may repeat; columns other than key and text are only carried along.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hash_share, map_texts, texts_of

BITS = 15
BUCKETS = 1 << BITS
GRAMS = (3, 4)
DIMENSIONS = 16
#: bytes of text whose grams are looked up at once
SLICE = 1 << 16

_BETWEEN = re.compile(r"[\W\d_]+").sub


@dataclass
class LanguageModel:
    """languages; the score of each gram bucket for each language; bias; temperature; least accepted score."""

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0


def words_of(text: str) -> str:
    """The lower-cased words of a text between single blanks, or nothing if it has no letter."""
    words = _BETWEEN(" ", f" {text.lower()} ")
    return words if any(map(str.isalpha, words)) else ""


def gram_buckets(data: np.ndarray):
    """For each gram length the buckets of the grams that begin at each byte."""
    wide = data.astype(np.uint32)
    for n in GRAMS:
        if len(wide) < n:
            continue
        h = wide[: len(wide) - n + 1] + np.uint32(1)
        for j in range(1, n):
            h = h * np.uint32(257) + wide[j: len(wide) - n + 1 + j]
        yield n, (h * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def text_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and the share of its grams in each."""
    data = np.frombuffer(words_of(text).encode("utf-8", "replace"), dtype=np.uint8)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for _, buckets in gram_buckets(data):
        counts += np.bincount(buckets, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at.astype(np.int32), (counts[at] / max(1, counts.sum())).astype(np.float32)


def fit(examples: list[tuple[str, np.ndarray, np.ndarray]], epochs: int = 6, rate: float = 4.0, seed: int = 1,
        lost: float = 0.002) -> LanguageModel:
    """Train on (language, buckets, shares). ``lost``: the share of held-back texts that the limit may reject."""
    languages = sorted({e[0] for e in examples})
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    number = {x: i for i, x in enumerate(languages)}
    train = [e for i, e in enumerate(examples) if i % 5] or examples
    held = [e for i, e in enumerate(examples) if i % 5 == 0]
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    softmax = np.zeros((DIMENSIONS, len(languages)), dtype=np.float32)
    bias = np.zeros(len(languages), dtype=np.float32)
    steps, done = epochs * len(train), 0
    for _ in range(epochs):
        for i in rng.permutation(len(train)):
            language, at, share = train[i]
            step = rate * (1 - done / steps)
            done += 1
            mean = share @ table[at]
            p = _softmax(mean @ softmax + bias)
            p[number[language]] -= 1
            back = softmax @ p
            softmax -= step * np.outer(mean, p)
            bias -= 0.1 * step * p
            table[at] -= step * share[:, None] * back
    model = LanguageModel(languages, (table @ softmax).astype(np.float32), bias)
    logits = np.array([share @ model.scores[at] + bias for _, at, share in held])
    truth = np.array([number[e[0]] for e in held])
    grid = np.geomspace(0.1, 10, 41)
    losses = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(truth)), truth], 1e-9)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(losses))])
    best = _softmax(logits / model.temperature).max(axis=1)
    model.least = float(min(0.5, np.quantile(best, lost)))
    return model


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def learn_languages(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = 800, seed: int = 5,
                    max_languages: int = 200) -> LanguageModel:
    """Fit on at most ``per_language`` different texts of each language, a sample by hash of the text, of the ``max_languages`` languages
    that most documents have. Whatever the keys or the number of copies, no more rows than that are gathered."""
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.md5(text).alias("_key"), F.col(text).alias("_text"), F.col(lang).alias("_lang"))
    sizes = known.groupBy("_lang").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.col("_n").desc(), "_lang").limit(max_languages)
    sizes = sizes.select("_lang", (F.lit(1.2 * per_language) / F.col("_n")).alias("_share"))
    place = F.row_number().over(Window.partitionBy("_lang").orderBy("_key"))  # of the sample, some hundreds a language
    sample = (known.join(F.broadcast(sizes), "_lang").filter(hash_share(F.col("_key"), F.col("_share"), seed))
              .groupBy("_key", "_lang").agg(F.first("_text").alias("_text"))
              .withColumn("_place", place).filter(F.col("_place") <= per_language).select("_key", "_text", "_lang"))

    def features(parts):
        for batch in parts:
            for i, text_ in enumerate(texts_of(batch)):
                at, share = text_features(text_)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(i, 1), batch.column(2).slice(i, 1), pa.array([at.tobytes()]), pa.array([share.tobytes()])],
                        names=["key", "lang", "at", "share"])

    rows = sample.mapInArrow(features, "key string, lang string, at binary, share binary").collect()
    rows.sort(key=lambda r: (r["key"] or "", r["lang"], bytes(r["at"])))
    order = np.random.default_rng(seed).permutation(len(rows))
    return fit([(rows[i]["lang"], np.frombuffer(rows[i]["at"], np.int32), np.frombuffer(rows[i]["share"], np.float32)) for i in order])


def score_texts(model: LanguageModel, texts: list[str]):
    """Language, calibrated score and rejection of each text."""
    n = len(model.languages)
    data = [words_of(t).encode("utf-8", "replace") for t in texts]
    sizes = np.array([len(d) for d in data], dtype=np.int64)
    total = np.zeros((len(texts), max(1, n)))
    grams = np.zeros(len(texts))
    ones = np.ones(SLICE, dtype=np.float32)
    for i in np.flatnonzero(sizes) if n else []:
        whole = np.frombuffer(data[i], dtype=np.uint8)
        for start in range(0, len(whole), SLICE):
            for size, buckets in gram_buckets(whole[start: start + SLICE + GRAMS[-1] - 1]):
                buckets = buckets[:SLICE]
                total[i] += ones[: len(buckets)] @ model.scores[buckets]
                grams[i] += len(buckets)
    if not n:
        return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    p = _softmax((total / np.maximum(grams, 1)[:, None] + model.bias) / model.temperature)
    found = grams > 0
    score = np.where(found, p.max(axis=1), 0.0)
    names = [model.languages[k] if f else "und" for k, f in zip(p.argmax(axis=1), found)]
    return names, score, ~found | (score < model.least)


def predict_language(df: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text", carry=(), prefix: str = "") -> DataFrame:
    """(key, *carry, lang_pred, score, rejected) of every whole text."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages scores
    outputs = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]

    def score(texts):
        names, scores, rejected = score_texts(shared.value, texts)
        return pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())

    return map_texts(df, key, text, outputs, score, carry, prefix)
