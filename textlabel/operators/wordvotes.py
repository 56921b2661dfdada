"""A small model that Spark fits on labelled texts and a predictor that applies it: each word votes for or against each label.

A word's vote is the log odds of the label among the documents that hold it, smoothed, in whole millionths, so that sums do not depend on
their order. The ``top`` words by documents vote; that bounds what goes to the workers.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MILLION = 1_000_000


def word_votes(train: DataFrame, label_cols: list[str], tokens: str = "tokens", top: int = 2000) -> tuple[dict, list[int]]:
    """The votes {word: [a vote for each label]} of the ``top`` words and the labels' priors; ``train`` has 0/1 labels."""
    ones = [F.sum(F.col(c).cast("long")).alias(c) for c in label_cols]
    total = train.agg(F.count(F.lit(1)).alias("_n"), *ones).first()
    words = train.select(F.explode(F.array_distinct(tokens)).alias("word"), *label_cols).groupBy("word").agg(F.count(F.lit(1)).alias("_n"), *ones)
    votes = []
    for c in label_cols:
        n1 = total[c] or 0
        n0 = total["_n"] - n1
        votes.append(F.round((F.log((F.col(c) + 1) / F.lit(n1 + 2.0)) - F.log((F.col("_n") - F.col(c) + 1) / F.lit(n0 + 2.0))) * MILLION).cast("long"))
    rows = words.orderBy(F.col("_n").desc(), F.col("word").asc()).limit(top).select("word", F.array(*votes).alias("votes")).collect()  # at most ``top``
    priors = train.sparkSession.range(1).select(*[F.round(F.log(F.lit((total[c] or 0) + 1.0) / F.lit(total["_n"] - (total[c] or 0) + 1.0)) * MILLION).cast("long").alias(c)
                                                  for c in label_cols]).first()
    return {r["word"]: list(r["votes"]) for r in rows}, [priors[c] for c in label_cols]


class WordVotes:
    """Answers a document's words with a JSON object of 0/1 labels: 1 where the prior and the votes of its distinct words are above 0."""

    def __init__(self, votes: dict, priors: list[int], label_cols: list[str]):
        self.votes, self.priors, self.labels = votes, priors, label_cols

    def sums(self, words) -> list[int]:
        """The prior and the votes of the distinct words, for each label, in millionths."""
        sums = list(self.priors)
        for w in set(words):
            for j, v in enumerate(self.votes.get(w, ())):
                sums[j] += v
        return sums

    def answer_batch(self, keys, inputs):
        return [json.dumps({c: int(s > 0) for c, s in zip(self.labels, self.sums(words))}) for words in inputs]


class SequenceVotes(WordVotes):
    """Scores encoded sequences: of (ids, mask) the ids that the mask keeps, from ``first`` on, vote; the answer is the list of sums."""

    def __init__(self, votes: dict, priors: list[int], label_cols: list[str], first: int = 4):
        super().__init__(votes, priors, label_cols)
        self.first = first

    def answer_batch(self, keys, inputs):
        return [json.dumps(self.sums(str(i) for i, m in zip(ids, mask) if m and i >= self.first)) for ids, mask in inputs]
