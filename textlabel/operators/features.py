"""Model features: bag-of-words counts and scales (AG11, AG12), word vectors (JN2, MTH2)
and sentence -> document embeddings (ML3 features)."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from . import lookup as LK
from .ranking import md5_key, md5_unit

#: (document, word) pairs of a block that are multiplied with their vectors at a time
PAIRS = 1 << 14
#: rows of a block that meets word vectors, a power of two: a vector is a few hundred bytes, and wider blocks share more of them
EMBED_ROWS = 2048
#: range of the hash vectors
LOW, HIGH = -0.25, 0.25


# ---- bag of words -----------------------------------------------------------------------

def bow_counts_fitted(df: DataFrame, tokens: str = "tokens", key: str = "doc_id",
                      split: str = "split", fit_on: str = "train") -> DataFrame:
    """AG11 long form: term counts of every row, kept for terms seen in the ``fit_on`` split
    (the vocabulary is fitted on train only). No indexed vocabulary is needed here: a
    semi join with the training split's distinct terms (map-side de-duplicated)."""
    tf = df.select(key, split, F.explode(tokens).alias("token")).groupBy(key, split, "token").agg(
        F.count(F.lit(1)).alias("tf"))
    fitted = tf.filter(F.col(split) == fit_on).select("token").distinct()
    return tf.join(fitted, "token", "left_semi")


def bow_scale_stats(counts: DataFrame, n_rows) -> DataFrame:
    """AG12: per-term population std over ``n_rows`` rows (absent = 0), no centring;
    a constant term keeps scale 1 (it is left unscaled).

    ``n_rows`` is an int or a one-row DataFrame with column ``n`` (kept distributed).
    """
    group = ["token", "idx"] if "idx" in counts.columns else ["token"]
    s = counts.groupBy(*group).agg(F.sum("tf").cast("double").alias("s1"),
                                           F.sum(F.col("tf") * F.col("tf")).cast("double").alias("s2"),
                                           F.count(F.lit(1)).alias("df"))
    if isinstance(n_rows, DataFrame):
        s = s.crossJoin(F.broadcast(n_rows.select(F.col("n").cast("double").alias("_n"))))  # one row
    else:
        s = s.withColumn("_n", F.lit(float(n_rows)))
    n = F.col("_n")
    var = F.greatest(F.col("s2") / n - F.pow(F.col("s1") / n, 2), F.lit(0.0))
    std = F.sqrt(var)
    return s.select(*group, "df", "s1", "s2", std.alias("std"),
                    F.when(std > 0, std).otherwise(F.lit(1.0)).alias("scale"))


# ---- word vectors ----------------------------------------------------------------------

def hash_vector(word: Column, dim: int, seed: int = 7, low: float = LOW, high: float = HIGH) -> Column:
    """A repeatable U(low, high) vector per word from md5(seed:word:d): the same on every
    partitioning and in SQL (stands in for the reference's unseeded random init)."""
    span = high - low
    return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)),
                       lambda d: F.lit(low) + F.lit(span) * md5_unit(md5_key(seed, word, d)) / F.lit(4294967296.0))


def l2_normalize(v: Column, eps: float = 1e-12) -> Column:
    """MTH2: v / max(||v||, eps); a zero vector stays zero."""
    def scaled(u):
        norm = F.sqrt(F.aggregate(u, F.lit(0.0), lambda a, x: a + x * x))
        return let(norm, lambda n: F.transform(u, lambda x: x / F.greatest(n, F.lit(eps))))
    return let(v, scaled)


def word_vectors(vocab: DataFrame, vectors: DataFrame, dim: int, seed: int = 7,
                 vec_key: str = "vec_id", vec_col: str = "embedding",
                 zero_tokens: tuple = (), on: str = "idx", hashed: bool = True) -> DataFrame:
    """JN2: (token, idx, known, vector) — the vector row whose key equals the vocabulary
    index (``on="idx"``) or the word itself (``on="word"``, the form of a vector file), else a hash vector. ``zero_tokens`` (e.g. ``("<pad>",)``) get zero vectors
    instead (option for quirk Q14, where specials get random vectors). Not ``hashed``: null in place of hash vectors."""
    if on not in ("idx", "word"):
        raise ValueError(f"vectors are found by idx or by word, not by {on}")
    side = "idx" if on == "idx" else "token"
    v = vectors.select(F.col(vec_key).cast("long" if on == "idx" else "string").alias(side),
                       F.col(vec_col).cast("array<double>").alias("_vec"))
    vec = F.coalesce("_vec", hash_vector(F.col("token"), dim, seed)) if hashed else F.col("_vec")
    if zero_tokens:
        vec = F.when(F.col("token").isin(*zero_tokens), F.array_repeat(F.lit(0.0), dim)).otherwise(vec)
    return (vocab.select("token", "idx").join(v, side, "left")
            .select("token", "idx", F.col("_vec").isNotNull().alias("known"), vec.alias("vector")))


def packed_vectors(wv: DataFrame, kind: str) -> DataFrame:
    """(token, given, hashed, norm) of ``word_vectors``, half as wide to send as normalised doubles: a known vector as it was given (``kind``), a hash
    vector by its 32-bit numbers, and the divisor of ``l2_normalize``. Nothing is rounded: ``unpacked`` gives the same doubles."""
    number = lambda x: ((x - F.lit(LOW)) / F.lit(HIGH - LOW) * F.lit(2.0 ** 32) - F.lit(2.0 ** 31)).cast("int")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    return wv.select("token", F.when(F.col("known"), F.col("vector").cast(kind)).alias("given"),
                     F.when(~F.col("known"), F.transform("vector", number)).alias("hashed"), F.greatest(norm, F.lit(1e-12)).alias("norm"))


def unpacked(entries: pa.Table, dim: int, last: np.ndarray) -> np.ndarray:
    """The normalised vectors of ``packed_vectors`` rows, and ``last`` below them."""
    given, hashed = (entries.column(c).combine_chunks() for c in ("given", "hashed"))
    known = given.is_valid().to_numpy(zero_copy_only=False)
    norm = entries.column("norm").to_numpy()[:, None]
    table = np.empty((entries.num_rows + 1, dim))
    table[:-1][known] = given.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) / norm[known]
    number = hashed.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) + 2.0 ** 31
    table[:-1][~known] = (LOW + (HIGH - LOW) * number / 4294967296.0) / norm[~known]
    table[-1] = last
    return table


#: MD5: the start, the constant of each step, its shift, the word of the message that it reads
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_STEPS = [(np.uint32(int(abs(np.sin(i + 1)) * 2 ** 32)), np.uint32(((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))[i // 16][i % 4]),
           (i, 5 * i + 1, 3 * i + 5, 7 * i)[i // 16] % 16) for i in range(64)]


def md5_heads(messages: np.ndarray) -> np.ndarray:
    """The first 32 bits, big-endian, of the MD5 of messages of one block each: (n, 64) bytes, padded as MD5 pads them."""
    m = np.ascontiguousarray(messages.view("<u4").T)
    a, b, c, d = (np.full(m.shape[1], x, np.uint32) for x in _START)
    f, t = np.empty_like(a), np.empty_like(a)
    for i, (k, shift, word) in enumerate(_STEPS):
        if i < 16:
            np.bitwise_xor(c, d, out=f), np.bitwise_and(f, b, out=f), np.bitwise_xor(f, d, out=f)
        elif i < 32:
            np.bitwise_xor(b, c, out=f), np.bitwise_and(f, d, out=f), np.bitwise_xor(f, c, out=f)
        elif i < 48:
            np.bitwise_xor(b, c, out=f), np.bitwise_xor(f, d, out=f)
        else:
            np.invert(d, out=f), np.bitwise_or(f, b, out=f), np.bitwise_xor(f, c, out=f)
        f += a
        f += m[word]
        f += k
        np.left_shift(f, shift, out=t)
        np.right_shift(f, np.uint32(32) - shift, out=f)
        t |= f
        np.add(t, b, out=a)
        a, b, c, d = d, a, b, c
    return (a + np.uint32(_START[0])).byteswap()


def hash_numbers(words: pa.Array, dim: int, seed: int) -> np.ndarray:
    """The 32-bit numbers of ``hash_vector``, a row a word. Words of a length are hashed together, about ``PAIRS`` numbers at a time."""
    out = np.empty((len(words), dim), np.uint32)
    data = words.cast(pa.binary())
    lengths = pc.binary_length(data).to_numpy(zero_copy_only=False)
    ends = [b":%d" % d for d in range(dim)]
    start = b"%d:" % seed
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for some in np.split(order, cuts):
        if not len(some):
            continue
        n = len(start) + int(lengths[some[0]])
        if n + max(map(len, ends)) > 55:  # more than one block
            for i in some:
                out[i] = [int.from_bytes(hashlib.md5(start + data[int(i)].as_py() + e).digest()[:4], "big") for e in ends]
            continue
        shape = np.zeros((dim, 64), np.uint8)  # of the messages, but for the word
        for d, e in enumerate(ends):
            shape[d, :len(start)] = np.frombuffer(start, np.uint8)
            shape[d, n:n + len(e) + 1] = np.frombuffer(e + b"\x80", np.uint8)
            shape[d, 56:58] = np.frombuffer((8 * (n + len(e))).to_bytes(2, "little"), np.uint8)
        for i in range(0, len(some), max(1, PAIRS // dim)):
            at = some[i:i + max(1, PAIRS // dim)]
            messages = np.repeat(shape[None], len(at), axis=0)
            messages[:, :, len(start):n] = np.frombuffer(b"".join(data.take(pa.array(at)).to_pylist()), np.uint8).reshape(len(at), 1, -1)
            out[at] = md5_heads(messages.reshape(-1, 64)).reshape(len(at), dim)
    return out


def with_hashes(entries: pa.Table, dim: int, seed: int) -> pa.Table:
    """(token, given, hashed, norm) as ``packed_vectors`` has them, of rows (token, given, norm) without hash vectors."""
    token, given, norm = (entries.column(c).combine_chunks() for c in ("token", "given", "norm"))
    new = given.is_null().to_numpy(zero_copy_only=False)
    number = hash_numbers(token.filter(pa.array(new)), dim, seed)
    norm = norm.to_numpy(zero_copy_only=False).copy()
    total = np.zeros(len(number))
    for d in range(dim):  # in the order of Spark's sum
        x = LOW + (HIGH - LOW) * number[:, d] / 4294967296.0
        total += x * x
    norm[new] = np.maximum(np.sqrt(total), 1e-12)
    ends = pa.array(np.append(0, np.cumsum(new) * dim).astype(np.int32), mask=np.append(~new, False))
    hashed = pa.ListArray.from_arrays(ends, pa.array((number ^ np.uint32(1 << 31)).view(np.int32).ravel()))
    return pa.table([token, given, hashed, pa.array(norm)], names=["token", "given", "hashed", "norm"])


def doc_embeddings(tokens_df: DataFrame | LK.Packed, vocab: DataFrame, vectors: DataFrame, dim: int,
                   key: str = "doc_id", tokens: str = "tokens", seed: int = 7, unk_idx: int = 0) -> DataFrame:
    """ML3 features: (key, embedding), the mean over the sentences of a document of the mean of its L2-normalised word vectors.

    The mean of means is one weighted mean: a token of a sentence of n tokens weighs 1 / (non-empty sentences x n). Documents lie in
    packed blocks; an entry comes once to a shelf of blocks for each distinct word of it (``operators.lookup``), a known vector as it was given, a hash
    vector as its word only, made where it is used. The block's (document, word) weights are multiplied with its vectors, a few thousand pairs at a time.
    Documents without a word are not in the result.
    """
    # one row: the vector of words outside the vocabulary
    unknown = word_vectors(vocab, vectors, dim, seed).filter(F.col("idx") == unk_idx).select(l2_normalize(F.col("vector")).alias("v")).first()
    unk = np.array(unknown["v"] if unknown else [0.0] * dim, dtype=np.float64)
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    dictionary = packed_vectors(word_vectors(vocab, vectors, dim, seed, hashed=False), kind).select("token", "given", "norm")
    laid = tokens_df if isinstance(tokens_df, LK.Packed) else LK.pack(tokens_df, key, tokens, EMBED_ROWS)

    def fold(keys: pa.ChunkedArray, per_row: np.ndarray, per_sentence: np.ndarray, numbers: np.ndarray, words: pa.Array, entries: pa.Table) -> pa.Table:
        n = len(per_row)
        sentence_row = np.repeat(np.arange(n), per_row)
        sentences = np.bincount(sentence_row, per_sentence > 0, n)
        share = 1.0 / np.maximum(sentences[sentence_row] * per_sentence, 1)
        found = LK.places(words, entries)
        table = unpacked(entries.take(pa.array(found[found >= 0])), dim, unk)  # of this block's words
        at = np.where(found >= 0, np.cumsum(found >= 0) - 1, len(table) - 1)[numbers]
        pair, which = np.unique(np.repeat(sentence_row, per_sentence) * len(table) + at, return_inverse=True)
        weight = np.bincount(which, np.repeat(share, per_sentence), len(pair))
        row, term = pair // len(table), pair % len(table)
        sums = np.zeros((n, dim))
        for i in range(0, len(pair), PAIRS):
            r = row[i:i + PAIRS]
            starts = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
            sums[r[starts]] += np.add.reduceat(weight[i:i + PAIRS, None] * table[term[i:i + PAIRS]], starts)
        full = sentences > 0
        embedding = LK.lists(pa.array(sums[full].ravel()), np.full(int(full.sum()), dim))
        return pa.table([keys.filter(pa.array(full)), embedding], names=[key, "embedding"])

    return LK.look_up_shelves(laid, dictionary, lambda entries: with_hashes(entries, dim, seed), fold, f"`{key}` {laid.kind}, embedding array<double>")
