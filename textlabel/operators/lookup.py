"""Dictionary lookup by blocks of documents (JN1, and the joins of AG11, ML2, ML3).

Tokens meet a dictionary (token -> number, scale, vector, weights) not once per occurrence but once per block: documents lie in blocks of at most
``ROWS`` consecutive rows, the distinct (block, token) pairs are joined with the dictionary, and what was found is folded back into its
block, where Arrow looks every occurrence up. A word in half of all places is one row per block; it cannot make a hot key, so there is
nothing to broadcast and no size to switch on. The documents move once, the pairs twice; a block's share of the dictionary is bounded
by the block's own words.

``pack`` stores wide blocks as a row each, compressed, with the block's words listed once and the documents as numbers in that list. Blocks that
lie together are a shelf (``shelves``): ``look_up_shelves`` brings an entry once to a shelf, and the blocks of a shelf are folded one by one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: rows of a block, a power of two
ROWS = 256
#: bytes of the documents of a packed block, about; packed blocks of a shelf, at most; shelves for each core that a table has before its shelves grow
PACKED, SHELF, SPARE = 1 << 25, 8, 3


def in_blocks(df: DataFrame, rows: int = ROWS) -> DataFrame:
    """``df`` with the number of its block, stored: blocks must not change between the two sides of a lookup."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.withColumn("_block", F.shiftright(F.monotonically_increasing_id(), rows.bit_length() - 1)).checkpoint(eager=True)


def nested(df: DataFrame, tokens: str) -> Column:
    """The tokens as sentences of words without nulls: a null text has no sentence, a null sentence no word."""
    col = F.col(tokens)
    if not df.schema[tokens].dataType.simpleString().startswith("array<array"):
        col = F.when(col.isNotNull(), F.array(col))
    return F.coalesce(F.transform(col, lambda s: F.coalesce(F.array_compact(s), F.array().cast("array<string>"))), F.array().cast("array<array<string>>"))


def block_words(laid: DataFrame, tokens: str) -> DataFrame:
    """Distinct (_block, token)."""
    return laid.select(F.col("_block").alias("_block"), F.explode(F.array_distinct(F.flatten(tokens))).alias("token")).distinct()


def look_up(laid: DataFrame, tokens: str, dictionary: DataFrame, fold: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``fold(documents, entries)`` for every block, where entries are the dictionary's rows for the block's words."""
    # a name of its own: both sides come from the same table
    entries = block_words(laid, tokens).join(dictionary, "token").withColumnRenamed("_block", "_entry_block")
    return laid.groupBy("_block").cogroup(entries.groupBy("_entry_block")).applyInArrow(fold, schema)


# ---- inside a block: nested Arrow lists as flat arrays and offsets --------------------------------

def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def flat_words(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of a column of sentences, the number of words of each sentence, and of sentences of each row."""
    rows = column.combine_chunks()
    sentences = rows.flatten()
    return sentences.flatten(), _lengths(sentences), _lengths(rows)


def places(words: pa.Array, entries: pa.Table) -> np.ndarray:
    """The row of ``entries`` that holds each word, -1 for none."""
    known = entries.column("token").combine_chunks()
    return pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def lists(values: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets(lengths).astype(np.int32)), values)


# ---- packed blocks ----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Packed:
    """Stored blocks of documents: ``blocks`` (_block, documents: the key and the number of words of each sentence, numbers: for each word its place in
    the block's list, words: that list, token and its count n, frequent ones first), all compressed."""

    blocks: DataFrame
    key: str
    kind: str  # of the key

    @property
    def sparkSession(self) -> SparkSession:  # noqa: N802
        return self.blocks.sparkSession

    def word_counts(self) -> DataFrame:
        """(_block, token, n), a row for each word of a block."""
        def run(batches):
            for batch in batches:
                for block, words in zip(batch.column(0), batch.column(1)):
                    for some in _unpacked(words).to_batches(max_chunksize=1 << 16):
                        yield pa.RecordBatch.from_arrays([pa.array([block.as_py()] * some.num_rows, pa.int64()), *some.columns], names=["_block", "token", "n"])

        return self.blocks.select("_block", "words").mapInArrow(run, "_block long, token string, n long")


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(data.as_buffer()).read_all()


def _packed_numbers(numbers: np.ndarray) -> bytes:
    """Small numbers, byte by byte: the high bytes are nearly all zero."""
    return pa.compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def _unpacked_numbers(data: pa.Scalar, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data.as_buffer(), 4 * n, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel().astype(np.int64)


def pack(df: DataFrame, key: str, tokens: str, rows: int) -> Packed:
    """The documents' keys and tokens in stored blocks of at most ``rows`` consecutive rows and about ``PACKED`` bytes."""
    ensure_checkpoint_dir(df.sparkSession)
    src = df.select(F.col(key), nested(df, tokens).alias("_tokens"))

    def block(held: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        documents = pa.Table.from_batches(held)
        words, per_sentence, per_row = flat_words(documents.column(1))
        coded = words.dictionary_encode()
        counts = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
        order = np.argsort(-counts, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        documents = pa.table([documents.column(0), lists(pa.array(per_sentence.astype(np.int32)), per_row)], names=[key, "sentences"])
        listed = pa.table([coded.dictionary.take(pa.array(order)), pa.array(counts[order], pa.int64())], names=["token", "n"])
        data = _packed(documents), _packed_numbers(place[coded.indices.to_numpy()]), _packed(listed)
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *(pa.array([x], pa.binary()) for x in data)], names=["_block", "documents", "numbers", "words"])

    def run(batches):
        held, n, size, number = [], 0, 0, TaskContext.get().partitionId() << 33
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                some = batch.slice(start, ROWS)
                if held and (n + some.num_rows > rows or size + some.nbytes > PACKED):
                    yield block(held, number)
                    held, n, size, number = [], 0, 0, number + 1
                held.append(some)
                n, size = n + some.num_rows, size + some.nbytes
        if held:
            yield block(held, number)

    blocks = src.mapInArrow(run, "_block long, documents binary, numbers binary, words binary").checkpoint(eager=True)
    return Packed(blocks, key, src.schema[0].dataType.simpleString())


def shelves(packed: Packed) -> Column:
    """The shelf of a block: at most ``SHELF`` blocks, neighbours of a partition and of partitions beside it, fewer while cores would be idle."""
    part = F.shiftright("_block", 33)
    size = packed.blocks.agg(F.count(F.lit(1)).alias("blocks"), F.countDistinct(part).alias("parts")).first()
    cores = packed.sparkSession.sparkContext.defaultParallelism
    most = min(SHELF, max(1, size["blocks"] // (SPARE * cores)))
    together = max(1, most * size["parts"] // max(1, size["blocks"]))  # partitions that share a shelf
    number = F.col("_block").bitwiseAND(F.lit((1 << 33) - 1))
    return F.shiftleft(F.floor(part / together).cast("long"), 33) + F.floor(number / max(1, most // together)).cast("long")


def look_up_shelves(packed: Packed, dictionary: DataFrame, prepare: Callable[[pa.Table], pa.Table],
                    fold: Callable[[pa.Array, np.ndarray, np.ndarray, np.ndarray, pa.Array, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``fold(keys, per_row, per_sentence, numbers, words, entries)`` for every block: its keys, the sentences of each row, the words of each sentence, each
    word's place in the block's list, that list; entries are what ``prepare`` makes, once for a shelf, of the dictionary's rows for the shelf's words."""
    shelf = shelves(packed)
    pairs = packed.word_counts().select(shelf.alias("_entry_shelf"), "token").distinct()
    entries = pairs.join(dictionary, "token")

    def one(documents: pa.Scalar, numbers: pa.Scalar, listed: pa.Scalar, entries: pa.Table) -> pa.Table:
        documents, listed = _unpacked(documents), _unpacked(listed)
        sentences = documents.column("sentences").combine_chunks()
        per_sentence = sentences.flatten().to_numpy().astype(np.int64)
        return fold(documents.column(0), _lengths(sentences), per_sentence, _unpacked_numbers(numbers, int(per_sentence.sum())), listed.column("token").combine_chunks(), entries)

    def run(blocks: pa.Table, entries: pa.Table) -> pa.Table:
        entries = prepare(entries)
        return pa.concat_tables([one(*data, entries) for data in zip(*(blocks.column(c) for c in ("documents", "numbers", "words")))])

    return packed.blocks.withColumn("_shelf", shelf).groupBy("_shelf").cogroup(entries.groupBy("_entry_shelf")).applyInArrow(run, schema)
