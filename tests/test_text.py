"""Text expressions against hand-made cases and small Python models of the same rules."""

import re

import pytest
from pyspark.sql import functions as F

from textlabel.functions import text as T


def _py_expand(s):
    # single-pass alternation with a callback: leftmost match, first key wins
    table = dict(T.CONTRACTIONS)
    rx = re.compile("|".join(re.escape(k) for k in table))
    return rx.sub(lambda m: table[m.group(0)], s)


def _py_force(text, k=20):
    words = re.sub(r"[^a-zA-Z0-9\s]", "", text).split()
    return [" ".join(words[i:i + k]) for i in range(0, len(words), k)]


def _py_sentences(text):
    out = []
    for piece in re.split(r"\.\s+|\.$", text):
        w = piece.split()
        if len(w) < 20:
            continue
        if len(w) > 100:
            out += [" ".join(w[i:i + 50]) for i in range(0, len(w), 50) if len(w[i:i + 50]) >= 20]
        else:
            out.append(" ".join(w))
    return out


def _py_basic(line):
    line = line.lower()
    for p, r in T.BASIC_ENGLISH_RULES:
        line = re.sub(p, r, line)
    return line.split()


def _col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id long, t {dtype}")
    return [r[0] for r in df.orderBy("id").select(expr).collect()]


CONTRACTION_CASES = ([k for k, _ in T.CONTRACTIONS] + ["she's", "bit's", "don't.", "it'she's", "don'they're",
                     "i'm sure i'll", "no apostrophe", "", "x’t don’t"])


def test_contractions_match_single_pass(spark):
    got = _col(spark, CONTRACTION_CASES, T.expand_contractions(F.col("t")))
    assert got == [_py_expand(c) for c in CONTRACTION_CASES]


def test_contractions_lowercase_first_and_null(spark):
    got = _col(spark, ["I'M HERE", "CAN'T", None], T.expand_contractions(F.lower("t")))
    assert got == ["I am here", "cannot", None]


def test_curly_apostrophe_is_stripped_by_cleaning(spark):
    assert _col(spark, ["Don’t stop."], T.clean_text("t")) == ["dont stop."]


def test_clean_keeps_period_digits_space(spark):
    assert _col(spark, ["Hi, there! 42 é.\tok"], T.clean_text("t")) == ["hi there 42 .\tok"]


SENTENCE_CASES = [
    "a.b", "a. b", "final period.", " ".join(["w"] * 19) + ".", " ".join(["w"] * 20) + ". rest",
    " ".join(["w%d" % i for i in range(100)]), " ".join(["w%d" % i for i in range(101)]),
    " ".join(["w%d" % i for i in range(119)]) + ". " + " ".join(["v"] * 120), "...", "tabs\tand\nnew lines " * 12,
    "non breaking " * 25, "",
]


def test_force_sentences_model(spark):
    got = _col(spark, SENTENCE_CASES, T.force_sentences("t"))
    assert got == [_py_force(c) for c in SENTENCE_CASES]


def test_split_sentences_model(spark):
    got = _col(spark, SENTENCE_CASES, T.split_sentences("t"))
    assert got == [_py_sentences(c) for c in SENTENCE_CASES]


@pytest.mark.parametrize("n", [0, 11, 12, 13])
def test_pad_truncate(spark, n):
    doc = [f"s{i}" for i in range(n)]
    df = spark.createDataFrame([(doc,)], "d array<string>")
    got = df.select(T.pad_truncate("d", 12).alias("p")).first()["p"]
    want = ["<pad>"] * (12 - n) + doc if n < 12 else doc[:12]
    assert got == want


def test_basic_english_tokens(spark):
    cases = ["Hello, World! (it's) \"quoted\" a.b;c:d <br />e?", "<pad>", "  ", "ÉTÉ  été"]
    assert _col(spark, cases, T.basic_english_tokens("t")) == [_py_basic(c) for c in cases]


def test_bow_tokens_unicode(spark):
    got = _col(spark, ["A cat, l'été ça va_bien x 42"], T.bow_tokens("t"))
    assert got == [re.findall(r"(?u)\b\w\w+\b", "a cat, l'été ça va_bien x 42")]


def test_word_count_and_strip(spark):
    assert _col(spark, ["  a  b\n c ", "", None], T.word_count("t")) == [3, 0, 0]
    assert _col(spark, ["\n {x} \t"], T.strip("t")) == ["{x}"]


def test_sentences_as_text(spark):
    df = spark.createDataFrame([(["a b", None],), ([],)], "s array<string>")
    assert [r[0] for r in df.select(T.pad_truncate("s", 3)).collect()] == [["<pad>", "a b", ""], ["<pad>"] * 3]
    words = spark.createDataFrame([([["a", "b"], None, []],)], "s array<array<string>>")
    assert [r[0] for r in words.select(T.pad_truncate("s", 3, words=True)).collect()] == [["a b", "", ""]]


def test_chunk_words_array(spark):
    df = spark.createDataFrame([([f"w{i}" for i in range(45)],), ([],)], "w array<string>")
    got = [r[0] for r in df.select(T.chunk_words(F.col("w"), 20)).collect()]
    assert got[0] == [" ".join(f"w{i}" for i in range(a, min(a + 20, 45))) for a in (0, 20, 40)]
    assert got[1] == []


def test_fold_curly_quotes_option(spark):
    assert _col(spark, ["Don’t"], T.clean_text("t", fold_curly_quotes=True)) == ["do not"]


def test_python_whitespace_set(spark):
    cases = ["a\x1cb c d", "x​y"]  # U+200B is not whitespace for Python
    assert _col(spark, cases, T.split_words("t")) == [c.split() for c in cases]
