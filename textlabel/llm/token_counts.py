"""Token counts by a two-tier lookup on the map side.

A text's pre-tokens (``pieces.segments``: no piece of the model crosses their borders) have lengths that add
up to the text's token count. The lengths of frequent pre-tokens are broadcast as one compact table of at most
``frequent`` entries of at most ``LONGEST`` characters each. What it lacks is encoded with the library, once for
each worker, which remembers it. Pre-tokens are never shuffled; only the documents' counts leave a task.

Which pre-tokens are frequent is read from at most about ``looked_at`` documents. This only decides what is
looked up where: the counts are the library's for every text, whatever the table holds.

Null and empty texts have 0 bytes and 0 tokens. Rows may repeat; every row is counted by itself. Columns
other than the key and the text are not read.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_and, texts_of
from .pieces import SPACE, piece_path, segments

#: pre-tokens longer than this are neither broadcast nor remembered
LONGEST = 40
#: pre-tokens a worker remembers beside the table before it starts anew
REMEMBERED = 600_000


@lru_cache(maxsize=2)
def _library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


_WORKER: dict[str, dict] = {}


def _lengths(path: str, words: list[str]) -> list[int]:
    """Token counts of pre-tokens by the library, whose own prefix stands for the first U+2581."""
    sp = _library(path)
    prefixed = [w[1:] if w.startswith(SPACE) else w for w in words]
    counts = [len(x) for x in sp.encode(prefixed, num_threads=1)]
    for i, w in enumerate(words):
        if w == SPACE:  # the library adds no prefix to an empty text
            counts[i] = 1
        elif not w.startswith(SPACE):  # it follows a line end: without a prefix
            counts[i] = len(sp.encode("\n" + w)) - len(sp.encode("\n"))
    return counts


def frequent_lengths(docs: DataFrame, text: str, path: str, frequent: int = 50_000, looked_at: int = 20_000) -> dict[str, int]:
    """The most frequent pre-tokens of about ``looked_at`` documents with their token counts."""
    total = docs.count()
    if total == 0:
        return {}
    some = docs.select(F.col(text).alias("text")).sample(fraction=min(1.0, looked_at / total), seed=7)
    words = (some.select(F.explode(F.split(F.regexp_replace("text", "\n", " \n "), " ")).alias("word"))
             .filter(F.length("word").between(1, LONGEST - 1) & ~F.col("word").contains(SPACE) & (F.col("word") != "\n"))
             .groupBy("word").count().orderBy(F.desc("count"), "word").limit(frequent))
    found = [SPACE + r["word"] for r in words.select("word").collect()]  # at most ``frequent`` short words
    return dict(zip(found, _lengths(path, found)))


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
                 limit: int = 4096, frequent: int = 50_000, looked_at: int = 20_000) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every whole text; over_limit: more than ``limit`` tokens."""
    path = piece_path(path)
    src = id_and(df, key, text)
    table = df.sparkSession.sparkContext.broadcast(frequent_lengths(df, text, path, frequent, looked_at))
    schema = T.StructType([src.schema[0], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(parts):
        first_tier = table.value
        own = _WORKER.setdefault(path, {"": 0})
        for batch in parts:
            counts: list[int] = []
            for start in range(0, batch.num_rows, 1000):
                split = [segments(t) for t in texts_of(batch.slice(start, 1000))]
                new = list(set().union(*split).difference(first_tier, own))
                if len(own) + len(new) > REMEMBERED:
                    own.clear()
                    own[""] = 0
                    new = list(set().union(*split).difference(first_tier, own))
                found = dict(zip(new, _lengths(path, new)))
                own.update((w, n) for w, n in found.items() if len(w) <= LONGEST)
                long = {w: n for w, n in found.items() if len(w) > LONGEST}
                for words in split:
                    total = 0
                    for w in words:
                        n = first_tier.get(w)
                        if n is None:
                            n = own.get(w)
                            if n is None:
                                n = long[w]
                        total += n
                    counts.append(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64()),
                 pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())], names=schema.names)

    return src.mapInArrow(run, schema)
