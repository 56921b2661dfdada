"""Best-fit packing of tokenised documents into sequences of a fixed length.

Pieces: a document's ids (``word_bpe_49k.json``) and an end id; a longer document is cut into full pieces and a rest.
Packing is bulk-synchronous best fit, exactly that of one document at a time. Documents are sorted by length and gaps by size; a superstep takes the next
length, longest first, and sweeps the sorted gaps for its successor, the smallest gap that holds it. Documents of the
length that ask for the same gaps are told apart by rank: the k-th document takes the k-th of the equal gaps; what is
left over goes on to the next larger gap and at last to new sequences. Then the gaps are updated and the next
superstep begins. Documents of one length and gaps of one size are interchangeable, so the sorted orders are held as
counts, at most one for each length up to the limit: a superstep moves (length, rank interval) against
(gap, sequence interval) and never rows. Rows are touched twice, by Spark: to be counted and ranked within
their lengths (hot lengths are dealt to buckets first), and to look up the interval that holds their rank.

Null and empty texts are documents of one token, the end id. Rows may repeat and each is packed. Documents without
an id have a null id in the result. Other columns are not read.
"""

from __future__ import annotations

import json
import string
import unicodedata
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held, id_and, slices, stored

#: buckets that the documents of one length are dealt to before they are ranked
BUCKETS = 64
#: words and pre-tokens that a worker remembers, in each of two generations
REMEMBERED = 200_000
#: bytes of the texts that are tokenised at a time, but for a longer one
SLICE = 1 << 21
#: longer words are not remembered
LONGEST = 60
#: ASCII's printable characters that are neither letters nor digits: a run of them is one pre-token
PUNCTUATION = string.punctuation


def word_path(path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def word_encoder(path: str) -> "WordEncoder":
    """A worker's encoder, with the words it has met; other operators' tasks free it."""
    return held(("words", path), lambda: WordEncoder(path))


class WordEncoder(dict):
    """The library's ids, found word by word. Blanks and line ends always separate pre-tokens, so a text's ids are
    those of its words one after the other; the encoder is the dictionary of the words and pre-tokens that a worker has met
    lately, and ``older`` that of the generation before.

    A new word of plain letters (where lower case and NFC act on each character alone) is cut with the file's own
    pattern, which leaves letters alone whole, and only its unknown pre-tokens go to the library's model; any other word
    goes through the whole library. A pre-token that is a word has the ids of that word, so one dictionary holds both.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        patterns = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut = regex.compile(patterns[0]).findall
        self.plain = {chr(c) for c in [*range(0x21, 0x7F), *range(0xC0, 0x180)]
                      if len(chr(c).lower()) == 1 and unicodedata.is_normalized("NFC", chr(c))}
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelt = {c: level.pre_tokenize_str(c)[0][0] for c in {p.lower() for p in self.plain}}
        self.has_special = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)").search
        #: all special texts have letters after a mark, so none lies in letters with marks after them
        self.apart = all(any(c.isalpha() for c in t.lstrip("".join(filter(str.isalpha, t)))) for t in self.special)
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if len(word) > LONGEST:
            return self.whole(word)
        ids = self.older.get(word)
        if ids is None:
            ids = self.found(word)
        self[word] = ids
        return ids

    def found(self, word: str) -> bytes:
        """The ids of a word that is not remembered."""
        low = word.lower()
        letters = low.rstrip(PUNCTUATION)
        simple = word.isascii() or self.plain.issuperset(word)
        if letters.isalpha() and simple and (self.apart or not self.has_special(word)):  # a word as most are, and the marks after it
            if letters == word:
                return self.token(word)
            ids = self.get(letters) or self.older.get(letters)
            if ids is None:
                ids = self[letters] = self.token(letters)
            return ids if letters == low else ids + self[low[len(letters):]]
        if simple and word.isprintable() and not self.has_special(word):
            return self.joined(low, word)
        return self.whole(word)

    def joined(self, low: str, word: str) -> bytes:
        cut = [low] if low.isalpha() else self.cut(low)
        return b"".join([self.token(p) if p == word else self[p] for p in cut])

    def token(self, pre: str) -> bytes:
        spelt = pre if pre.isascii() else "".join(map(self.spelt.__getitem__, pre))
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def whole(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian uint32 ids of a text."""
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts one after the other, null as empty, and the places where each of them begins and the last ends. A word
        that they repeat is looked up once."""
        if len(self) > REMEMBERED:  # what has not been met again by the next time is forgotten
            self.older = dict(self)
            self.clear()
        words = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        met = words.values.dictionary_encode()
        ids = list(map(self.__getitem__, met.dictionary.to_numpy(zero_copy_only=False).tolist()))
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first, code = np.cumsum(size) - size, met.indices.to_numpy()
        each = size[code]
        end = np.cumsum(each)
        places = np.repeat(first[code] - end + each, each)
        places += np.arange(len(places))
        return np.frombuffer(b"".join(ids), "<u4")[places], np.r_[0, end][words.offsets.to_numpy()]


def token_pieces(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
                 limit: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]) of every whole text; ids: little-endian uint32 bytes."""
    path = word_path(path)
    src = id_and(df, key, text)
    fields = [src.schema[0], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    fields += [T.StructField("ids", T.BinaryType())] * with_ids
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(parts):
        encoder = word_encoder(path)
        for batch in parts:
            for rows in slices(batch, SLICE):
                owner, piece, start, cuts = [], [], [], []
                found, ends = encoder.encode_all(rows.column(1))
                found, ends = found.tobytes(), (4 * ends).tolist()
                for i, (first, last) in enumerate(zip(ends, ends[1:])):
                    ids = found[first:last] + end
                    for k, at in enumerate(range(0, len(ids), 4 * limit)):
                        owner.append(i)
                        piece.append(k)
                        start.append(at // 4)
                        cuts.append(ids[at: at + 4 * limit])
                columns = [rows.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                           pa.array([len(c) // 4 for c in cuts], pa.int64()), pa.array(map(zlib.crc32, cuts), pa.int64())]
                columns += [pa.array(cuts, pa.binary())] * with_ids
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return src.mapInArrow(run, T.StructType(fields))


def best_fit(counts: dict[int, int], limit: int) -> tuple[list[tuple], int]:
    """The supersteps over counts of documents by length: rows (length, first rank, documents, first sequence,
    offset), where document ``first rank + i`` goes to sequence ``first sequence + i``; and the number of sequences."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # size: intervals (first sequence, sequences)
    sizes: list[int] = []
    placed: list[tuple] = []
    opened = 0

    def add(size: int, interval: tuple[int, int]) -> None:
        if size:
            if size not in gaps:
                gaps[size] = []
                insort(sizes, size)
            gaps[size].append(interval)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            else:
                gap, first, n = limit, opened, -(-left // (limit // length))
                opened += n
            each = gap // length  # what is left of the smallest gap is the smallest still: it is filled before the next equal one
            full = min(n, left // each)
            for slot in range(each if full else 0):
                placed.append((length, rank, full, first, limit - gap + slot * length))
                rank += full
            left -= full * each
            if full:
                add(gap - each * length, (first, full))
            if full < n and left:  # fewer documents than the next sequence holds
                for slot in range(min(left, each)):
                    placed.append((length, rank, 1, first + full, limit - gap + slot * length))
                    rank += 1
                add(gap - min(left, each) * length, (first + full, 1))
                left -= min(left, each)
                full += 1
            if full < n:
                add(gap, (first + full, n - full))
    return placed, opened


def pack(pieces: DataFrame, limit: int = 4096, key: str = "doc_id") -> DataFrame:
    """``pieces`` (with key, piece, length of 1 to ``limit``) and sequence_id, offset."""
    spark = pieces.sparkSession
    pieces = stored(pieces)  # ranks and counts must come from the same rows
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(BUCKETS)).cast("int"))
    counts = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # at most limit x BUCKETS rows
    offsets = counts.select("length", "_bucket", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    by_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most ``limit``
    placed, _ = best_fit(by_length, limit)
    schema = "length long, _rank long, _docs long, _sequence long, offset long"
    steps = spark.createDataFrame([tuple(map(int, p)) for p in placed], schema)
    ranked = (dealt.withColumn("_in", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(key, "piece", "ids_crc32")) - 1)
              .join(F.broadcast(offsets.drop("_n")), ["length", "_bucket"])
              .withColumn("_k", F.col("_before") + F.col("_in")))
    return (ranked.join(F.broadcast(steps), (ranked["length"] == steps["length"]) & (F.col("_k") >= F.col("_rank"))
                        & (F.col("_k") < F.col("_rank") + F.col("_docs"))).drop(steps["length"])
            .withColumn("sequence_id", F.col("_sequence") + F.col("_k") - F.col("_rank"))
            .select(*pieces.columns, "sequence_id", "offset"))
