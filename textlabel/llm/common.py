"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


_held: dict = {}


def held(name, make):
    """What a worker keeps from task to task for one operator, made when it is not there. Workers live on from stage to stage: what another
    operator kept goes first."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def forget() -> None:
    """An operator that keeps nothing begins: what ``held`` has is given up, and the memory that Arrow's pool has and no longer uses."""
    _held.clear()
    release()


def release() -> None:
    """Give Arrow's unused memory back to the system; else its pool keeps what a worker's largest batches took, as long as the worker lives."""
    pa.default_memory_pool().release_unused()


def stored(df: DataFrame, few: bool = False) -> DataFrame:
    """``df`` as a reliable checkpoint in the shared folder (``spark.checkpoint.dir``). ``few``: for tables far smaller than the input, as
    fewer files: one for each 32 shuffle partitions, or for each core."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if few:
        df = df.coalesce(max(1, spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 32))
    return df.checkpoint(eager=True)


def id_and(df: DataFrame, key: str, *cols) -> DataFrame:
    """Only the key and the columns an operator reads: further columns, whatever their names, cannot clash."""
    return df.select(F.col(key), *[F.col(c) for c in cols])


def texts_of(batch: pa.RecordBatch, column: int = 1) -> list:
    """The text column of an Arrow batch as Python strings, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def int_lists(values: np.ndarray, lengths) -> pa.ListArray:
    """An Arrow list<int32> column from concatenated values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32, copy=False)))


def slices(batch: pa.RecordBatch, size: int, column: int = 1, rows: int = 4096):
    """Slices of a batch of at most ``rows`` rows whose texts hold about ``size`` bytes each (one row at least),
    so that working arrays stay bounded whatever the length of the texts. What they took is released after the last."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and (total + n > size or i - start == rows):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)
    release()


def map_texts(df: DataFrame, key: str, text: str, outputs: list[T.StructField], score, carry=(), prefix: str = "",
              size: int = 1 << 20) -> DataFrame:
    """(key, *carry, outputs) where ``score(texts)`` gives an Arrow array for each output. ``prefix`` goes before
    the names of the outputs, for tables that have such columns already."""
    src = df.select(F.col(key), F.col(text).alias("_text"), *[F.col(c) for c in carry if c != key])
    fields = [src.schema[0], *src.schema[2:], *[T.StructField(prefix + f.name, f.dataType) for f in outputs]]
    names = [f.name for f in fields]

    def run(parts):
        forget()
        for batch in parts:
            for rows in slices(batch, size):
                yield pa.RecordBatch.from_arrays([rows.column(0), *rows.columns[2:], *score(texts_of(rows))], names=names)

    return src.mapInArrow(run, T.StructType(fields))


def hash_share(key, share, seed: int):
    """True for the rows whose key hashes into the given share (0 to 1): a sample that no partitioning changes."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1_000_000)) < share * 1_000_000
