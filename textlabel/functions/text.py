"""Text expressions (STR1-STR13, WN1): every function maps Column -> Column.

All of them are native Catalyst expressions, so they stay inside whole-stage
codegen and run unchanged on batch and streaming DataFrames.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical output).
# Contraction table, in the reference's order; keys are matched on lower-case text.
CONTRACTIONS: list[tuple[str, str]] = [
    ("i'm", "I am"),
    ("i'll", "I will"),
    ("you're", "you are"),
    ("he's", "he is"),
    ("she's", "she is"),
    ("it's", "it is"),
    ("we're", "we are"),
    ("they're", "they are"),
    ("isn't", "is not"),
    ("aren't", "are not"),
    ("wasn't", "was not"),
    ("weren't", "were not"),
    ("haven't", "have not"),
    ("hasn't", "has not"),
    ("hadn't", "had not"),
    ("won't", "will not"),
    ("wouldn't", "would not"),
    ("don't", "do not"),
    ("doesn't", "does not"),
    ("didn't", "did not"),
    ("can't", "cannot"),
    ("couldn't", "could not"),
    ("shouldn't", "should not"),
    ("mightn't", "might not"),
    ("mustn't", "must not"),
]

# The public `basic_english` normaliser (pattern, replacement), applied
# in this order to lower-cased text, then split on whitespace.
BASIC_ENGLISH_RULES: list[tuple[str, str]] = [
    (r"'", " '  "),
    (r'"', ""),
    (r"\.", " . "),
    (r"<br \/>", " "),
    (r",", " , "),
    (r"\(", " ( "),
    (r"\)", " ) "),
    (r"\!", " ! "),
    (r"\?", " ? "),
    (r"\;", " "),
    (r"\:", " "),
    (r"\s+", " "),
]

# ---------------------------------------------------------------------------

# Python's whitespace (``str.isspace``, ``re`` \s on str) is Java's Unicode \s plus
# U+001C-U+001F, as a character-class body. Used with the (?U) flag: Java matches a long
# explicit list of ranges several times slower, especially inside a negated class.
PY_SPACE = r"\s\x1C-\x1F"
WS = r"(?U)[" + PY_SPACE + "]+"
SENTENCE_BREAK = r"(?U)\.[" + PY_SPACE + r"]+|\.$"

# Sentinels that bracket a contraction matched by the single regex pass.
_OPEN, _CLOSE = "\u0001", "\u0002"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(expr: Column, body) -> Column:
    """Evaluate ``expr`` once and pass it to ``body`` as a lambda variable.

    A derived column referenced inside a lambda would otherwise be re-evaluated for every
    array element."""
    return F.transform(F.array(expr), body)[0]


def contraction_pattern() -> str:
    return "(" + "|".join(re.escape(k) for k, _ in CONTRACTIONS) + ")"


def expand_contractions(c) -> Column:
    """STR2: replace every contraction in one left-to-right pass.

    A single regex pass brackets each match exactly where an alternation regex with a
    callback would replace it (leftmost match, first key in table order wins); 25 literal
    replaces then swap each bracketed key for its expansion. Rows without an apostrophe
    skip the work.
    """
    c = _col(c)
    marked = F.regexp_replace(c, contraction_pattern(), _OPEN + "$1" + _CLOSE)
    for key, value in CONTRACTIONS:
        marked = F.replace(marked, F.lit(_OPEN + key + _CLOSE), F.lit(value))
    return F.when(F.instr(c, "'") > 0, marked).otherwise(c)


def keep_text_chars(c, keep_period: bool = True) -> Column:
    """STR3 (letters, digits, whitespace, period) / STR4 (period removed too)."""
    pattern = "(?U)[^a-zA-Z0-9" + PY_SPACE + (".]" if keep_period else "]")
    return F.regexp_replace(_col(c), pattern, "")


def fold_quotes(c) -> Column:
    """Curly single quotes -> straight apostrophe (option for quirk Q16)."""
    return F.translate(_col(c), "‘’ʼ", "'" * 3)


def clean_text(c, fold_curly_quotes: bool = False) -> Column:
    """STR1 + STR2 + STR3: lower, expand contractions, keep letters/digits/space/period.

    Only straight apostrophes are in the contraction table, so by default a curly one is
    simply stripped (``don’t`` -> ``dont``, quirk Q16); ``fold_curly_quotes`` folds it first.
    """
    text = F.lower(_col(c))
    if fold_curly_quotes:
        text = fold_quotes(text)
    return keep_text_chars(expand_contractions(text), keep_period=True)


def split_words(c) -> Column:
    """STR6: whitespace split without empty pieces (Python ``str.split()``)."""
    return F.filter(F.split(F.coalesce(_col(c), F.lit("")), WS), lambda w: w != "")


def word_count(c) -> Column:
    return F.size(split_words(c))


def normalize_spaces(c) -> Column:
    """Words separated by exactly one blank, no leading/trailing space (``' '.join(s.split())``)."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(_col(c), F.lit("")), WS, " "), r"^ | $", "")


def chunk_text(c, k: int) -> Column:
    """WN1: consecutive chunks of ``k`` words, each joined by one blank.

    One linear regex pass over the blank-normalised text: every match takes up to ``k``
    words, and the next match starts at the following word.
    """
    return F.regexp_extract_all(normalize_spaces(c), F.lit(r"[^ ]+(?: [^ ]+){0,%d}" % (k - 1)), 0)


def chunk_words(words, k: int) -> Column:
    """WN1 on an array of words (bound once as a lambda variable, never re-evaluated)."""
    def chunks(w):
        n = F.size(w)
        return F.when(n > 0, F.transform(
            F.sequence(F.lit(0), F.floor((n - 1) / k).cast("int")),
            lambda i: F.array_join(F.slice(w, i * k + 1, F.lit(k)), " "))).otherwise(
            F.array().cast("array<string>"))
    return let(_col(words), chunks)


def force_sentences(c, max_words: int = 20) -> Column:
    """STR7: strip everything but letters/digits/whitespace, then cut into ``max_words`` chunks.

    The cleaning removes periods before the period split, so that split never cuts
    (quirk Q1): the chunks run across sentence ends. We therefore chunk the words directly.
    """
    return chunk_text(keep_text_chars(F.coalesce(_col(c), F.lit("")), keep_period=False), max_words)


def split_sentences(c, min_words: int = 20, long_words: int = 100, chunk: int = 50) -> Column:
    """STR8: sentence split; drop sentences under ``min_words``; cut sentences over
    ``long_words`` into ``chunk``-word pieces, keeping pieces of at least ``min_words``.

    Each piece is normalised once and bound as a lambda variable, so nothing is
    re-evaluated per chunk.
    """
    pieces = F.transform(F.split(F.coalesce(_col(c), F.lit("")), SENTENCE_BREAK), normalize_spaces)

    def per_sentence(p):
        n = F.when(p == "", F.lit(0)).otherwise(F.size(F.split(p, " ")))
        parts = F.filter(F.regexp_extract_all(p, F.lit(r"[^ ]+(?: [^ ]+){0,%d}" % (chunk - 1)), 0),
                         lambda part: F.size(F.split(part, " ")) >= min_words)
        return (F.when(n < min_words, F.array().cast("array<string>"))
                 .when(n > long_words, parts)
                 .otherwise(F.array(p)))

    return F.flatten(F.transform(pieces, per_sentence))


def sentence_text(c, words: bool = False) -> Column:
    """STR9: a sentence as text; null is the empty text, a list of words (``words``) is joined by blanks."""
    s = _col(c)
    return F.coalesce(F.array_join(s, " ") if words else s, F.lit(""))


def pad_truncate(sentences, n: int = 12, pad: str = "<pad>", words: bool = False) -> Column:
    """ARR1 + LIM1 + STR9: left-pad a document to ``n`` sentences with ``pad`` or keep the first ``n``.
    Sentences that are null become empty; ``words``: they are lists of words, which are joined."""
    s = F.transform(_col(sentences), lambda x: sentence_text(x, words))
    return F.concat(F.array_repeat(F.lit(pad), F.greatest(F.lit(n) - F.size(s), F.lit(0))),
                    F.slice(s, 1, n))


def basic_english_tokens(c) -> Column:
    """STR10: the `basic_english` tokenizer as a fold of native regex replaces."""
    line = F.lower(_col(c))
    for pattern, repl in BASIC_ENGLISH_RULES:
        line = F.regexp_replace(line, "(?U)" + pattern.replace(r"\s", "[" + PY_SPACE + "]"), repl)
    return split_words(line)


def tokenize_sentences(sentences) -> Column:
    """Tokenise each sentence of a document: array<string> -> array<array<string>>."""
    return F.transform(_col(sentences), basic_english_tokens)


def bow_tokens(c) -> Column:
    """STR11: bag-of-words tokens, lower case, Unicode ``\\b\\w\\w+\\b``."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(r"(?U)\b\w\w+\b"), 0)


def text_length(c) -> Column:
    """STR12: length in code points."""
    return F.length(_col(c))


def strip(c) -> Column:
    """STR13: Python ``str.strip()``."""
    return F.regexp_replace(_col(c), "(?U)^[" + PY_SPACE + "]+|[" + PY_SPACE + "]+$", "")
