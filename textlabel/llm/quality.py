"""Text quality by compression: which of two zstandard dictionaries makes a text smaller.

One dictionary is built from texts labelled good, one from texts labelled bad. A text is compressed whole, in blocks of
``BLOCK`` bytes so that its own history does not hide the dictionaries, with each of them; the feature is the difference of
the two compressed sizes over the size of the text. A logistic curve, fitted on labelled texts that built neither
dictionary, turns it into log-odds that are added to those of the labels, weighed by bytes / (bytes + ``WEAK``): a text of
a few words is judged little by them.

Fitting reads about ``per_label`` documents of each label and about ``blocks`` of their blocks, drawn over all of them. Null and empty
texts score the share of label 1; without labels of both kinds (an empty table too) every text scores 0.5. Rows may repeat; columns
other than key and text are only carried along. Equal sizes under both dictionaries, a tie, score the share of label 1 moved by the curve's
offset.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hash_share, map_texts, stored

BLOCK = 2048
DICTIONARY = 64 << 10
LEVEL = 3
#: bytes of text at which the compressed sizes count by half
WEAK = 100


@dataclass
class QualityModel:
    """The two dictionaries, slope and offset of the curve, and the log-odds of label 1 among all labels."""

    good: bytes
    bad: bytes
    slope: float
    offset: float
    prior: float

    def score(self, x: np.ndarray, weight: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.prior + weight * (self.slope * x + self.offset), -30, 30)))


def blocks_of(text: str) -> list[bytes]:
    data = text.encode("utf-8", "replace")
    return [data[i: i + BLOCK] for i in range(0, len(data), BLOCK)]


class Sizes:
    """Compressed sizes under the two dictionaries (built once in each worker)."""

    def __init__(self, model: QualityModel):
        import zstandard

        self.compress = []
        for data in (model.good, model.bad):
            words = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT if data[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=LEVEL)
            self.compress.append(zstandard.ZstdCompressor(dict_data=words, write_content_size=False, write_dict_id=False).compress)

    def difference(self, blocks: list[bytes]) -> tuple[float, float]:
        """(size under bad - size under good) / bytes, and its weight."""
        good, bad = self.compress
        total = sum(map(len, blocks))
        return (sum(len(bad(b)) - len(good(b)) for b in blocks) / total if total else 0.0), total / (total + WEAK)


def dictionary(blocks: list[bytes]) -> bytes:
    """A zstandard dictionary of the blocks; the blocks themselves where they are too few to train one."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[:DICTIONARY] or b"\n" * 8


def fit(examples: list[tuple[int, list[bytes]]], share: float) -> QualityModel | None:
    """Dictionaries from every other example of each label, the curve from the rest; ``share``: of label 1 among all labels."""
    by_label = [[e[1] for e in examples if e[0] == k] for k in (0, 1)]
    if min(map(len, by_label)) < 2:
        return None
    bad, good = (dictionary([b for doc in docs[::2] for b in doc]) for docs in by_label)
    model = QualityModel(good, bad, 1.0, 0.0, float(np.log(share / (1 - share))))
    sizes = Sizes(model)
    x, weight = np.array([sizes.difference(doc) for docs in by_label for doc in docs[1::2]]).T
    y = np.array([k for k, docs in enumerate(by_label) for _ in docs[1::2]], dtype=float)
    model.slope, model.offset = logistic_curve(x, weight, y, share, model.prior)
    return model


def logistic_curve(x: np.ndarray, weight: np.ndarray, y: np.ndarray, share: float, prior: float, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset by Newton's method with a weak ridge; the labels weigh as they do in the corpus."""
    scale = x.std() or 1.0
    a = np.column_stack([x / scale, np.ones(len(x))]) * weight[:, None]
    each = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum())) * len(y)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(prior + a @ w, -30, 30)))
        h = (a * (each * p * (1 - p))[:, None]).T @ a + np.eye(2) * 1e-2
        w -= np.linalg.solve(h, a.T @ (each * (p - y)) + 1e-2 * w)
    return float(w[0] / scale), float(w[1])


def learn_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
                  per_label: int = 1500, seed: int = 9, blocks: int = 24_000) -> QualityModel | None:
    """Fit on about ``per_label`` documents of each label, a sample by hash of the key, one row of each key, and of their blocks on about
    ``blocks``, a sample by hash over all of them: no more is gathered, whatever the keys and the texts' length."""
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).filter(F.col("_label").isin(0, 1)).distinct()
    sizes = known.groupBy("_label").agg(F.count(F.lit(1)).alias("_n"), (F.lit(float(per_label)) / F.count(F.lit(1))).alias("_share"))
    counts = {r["_label"]: r["_n"] for r in sizes.collect()}
    if len(counts) < 2:
        return None
    picked = known.join(F.broadcast(sizes), "_label").filter(hash_share(F.col("_key"), F.col("_share"), seed)).select("_key", "_label")
    named = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.md5(text).alias("_digest"))
    sample = stored(named.join(F.broadcast(picked), "_key").groupBy("_key", "_label").agg(F.min_by("_text", "_digest").alias("_text")))  # 2 x per_label rows
    held = sample.agg(F.coalesce(F.sum(F.ceil(F.octet_length("_text") / BLOCK)), F.lit(0)).alias("n")).first()["n"]
    share = min(1.0, blocks / max(held, 1))

    def cut(parts):
        for batch in parts:
            for key_, text_, label_ in zip(*(c.to_pylist() for c in batch.columns)):
                found = blocks_of(text_ or "")
                chosen = [b for i, b in enumerate(found) if share == 1.0 or zlib.crc32(f"{i}:".encode() + b) < share * 2 ** 32]
                if chosen:
                    yield pa.RecordBatch.from_arrays([pa.array([str(key_)]), pa.array([label_], pa.int32()), pa.array([chosen], pa.list_(pa.binary()))],
                                                     names=["key", "label", "blocks"])

    rows = sample.select("_key", "_text", "_label").mapInArrow(cut, "key string, label int, blocks array<binary>").collect()
    rows.sort(key=lambda r: (r["key"], r["label"], [bytes(b) for b in r["blocks"]]))
    order = np.random.default_rng(seed).permutation(len(rows))
    return fit([(rows[i]["label"], [bytes(b) for b in rows[i]["blocks"]]) for i in order], counts[1] / (counts[0] + counts[1]))


def score_quality(df: DataFrame, model: QualityModel | None, key: str = "doc_id", text: str = "text", limit: float = 0.3,
                  carry=(), prefix: str = "") -> DataFrame:
    """(key, *carry, score, predicted) of every whole text; predicted: 1 where score >= ``limit``."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    outputs = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    worker: list[Sizes] = []

    def score(texts):
        m = shared.value
        if m is None:
            scores = np.full(len(texts), 0.5)
        else:
            if not worker:
                worker.append(Sizes(m))
            scores = m.score(*np.array([worker[0].difference(blocks_of(t)) for t in texts]).T)
        return pa.array(scores, pa.float64()), pa.array((scores >= limit).astype(np.int32), pa.int32())

    return map_texts(df, key, text, outputs, score, carry, prefix)
