"""Corpus scans (SRC1-SRC4).

``read_corpus_csv`` reads multi-line quoted CSV by byte ranges; it is meant to be run once and written to Parquet
(``csv_to_parquet``): every later job reads Parquet with column pruning and filter pushdown.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from ..session import spread as spread_wide

REFERENCE_LABELS = ["cEXT", "cNEU", "cAGR", "cCON", "cOPN"]


def corpus_schema(label_cols=REFERENCE_LABELS, text_col: str = "TEXT", extra: list[str] | None = None) -> T.StructType:
    fields = [T.StructField(c, T.StringType(), True) for c in (extra or [])]
    fields.append(T.StructField(text_col, T.StringType(), True))
    fields += [T.StructField(c, T.StringType(), True) for c in label_cols]
    return T.StructType(fields)


def _charset(spark: SparkSession, encoding: str) -> str:
    """The JVM's name of the charset. Spark rejects legacy charsets unless ``spark.sql.legacy.javaCharsets`` is on."""
    if encoding.lower().replace("-", "").replace("_", "") in ("xmacroman", "macroman"):
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
        return "x-MacRoman"
    return encoding


def header_of(spark: SparkSession, path: str, encoding: str = "x-MacRoman") -> list[str]:
    """The column names: only the first record is read."""
    return (spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
            .option("encoding", _charset(spark, encoding)).csv(path).columns)


def read_corpus_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                    encoding: str = "x-MacRoman", line_sep: str = "\n") -> DataFrame:
    """SRC1: header CSV with quoted multi-line text in Mac Roman (or any charset that keeps ASCII bytes), quotes escaped by doubling, read
    by byte ranges in parallel.

    Whether a line end closes a record depends on the number of quotes before it, so each split counts its quotes; their parity, added up
    over the splits of a file (a row a split), tells in which state each split begins. Every split then cuts its lines into records by
    itself; a record that crosses splits leaves a piece in each, and only these pieces are brought together. Without a schema the
    header decides the columns (all strings); with one, the header must name its columns. Row order is not kept.
    """
    charset = _charset(spark, encoding)
    names = header_of(spark, path, encoding)
    if schema is not None and list(schema.names) != names:
        raise ValueError(f"the header of {path} names {names}, not {list(schema.names)}")
    schema = schema or T.StructType([T.StructField(c, T.StringType(), True) for c in names])
    lines = spark.read.option("lineSep", line_sep).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value"))
    ends = F.struct(F.monotonically_increasing_id().alias("at"), F.col("value").endswith("\r").alias("cr"))  # of the split's lines, in order
    splits = lines.withColumn("ends", ends).groupBy("file", "start").agg(F.sum(F.regexp_count("value", F.lit('"'))).alias("quotes"), F.min("ends").alias("ends"))
    order = Window.partitionBy("file").orderBy("start")
    before = F.sum("quotes").over(order.rowsBetween(Window.unboundedPreceding, -1))
    states = splits.select("file", "start", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside"), F.first("ends.cr").over(order).alias("cr"))
    # a row a split: its number is that of the byte ranges, whatever they hold
    told = lines.join(F.broadcast(states), ["file", "start"]).select("file", "start", "inside", F.col("value").cast("binary").alias("line"), "cr")
    cut = told.mapInArrow(_cut_records(line_sep.encode()), "file string, start long, kind int, record binary")
    ensure_checkpoint_dir(spark)
    cut = cut.checkpoint(eager=True)  # read twice; the pieces of a record are told by their order here
    pieces = cut.filter(F.col("kind") != WHOLE)
    number = F.sum((F.col("kind") == OPENS).cast("long")).over(Window.partitionBy("file").orderBy("start", "kind"))
    parts = pieces.withColumn("number", number).groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "record"))).alias("parts"))
    hexed = F.array_join(F.transform("parts", lambda p: F.hex(p["record"])), "")
    whole = cut.filter(F.col("kind") == WHOLE).select("record").unionByName(parts.select(F.unhex(hexed).alias("record")))
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true"}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return whole.select(F.from_csv(F.decode("record", charset), ddl, options).alias("r")).select("r.*")


#: a record that lies in one split; the end of one that began in an earlier split, or the middle of one; the start of one that goes on
WHOLE, CLOSES, PASSES, OPENS = 0, 1, 2, 3


def _cut_records(sep: bytes):
    """Lines of a partition, split after split in order, as records and pieces of records. The header (one line) and empty records are left
    out. Where a file's header ends in a carriage return, its line ends are read as single line feeds, in quotes too."""
    def run(batches):
        file, start, inside, began, held, first = None, None, False, False, [], False
        out: list = []

        def emit(kind, lines, last):
            text = sep.join(lines) + (b"" if last else sep)
            if not (kind == WHOLE and (first or not text)):
                out.append((file, start, kind, text))

        def leave():  # the split is over: what is held goes on in the next one, or was the file's last record
            if held:
                emit(OPENS if began else PASSES, held, False)

        for batch in batches:
            for f, s, state, line, cr in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if (f, s) != (file, start):
                    leave()
                    file, start, inside, began, held = f, s, state, not state, []
                    first = s == 0
                held.append(line[:-1] if cr and line.endswith(b"\r") else line)
                inside ^= line.count(b'"') % 2 == 1
                if not inside:
                    emit(WHOLE if began else CLOSES, held, True)
                    began, held, first = True, [], False
            if out:
                yield _record_batch(out)
                out = []
        leave()
        if out:
            yield _record_batch(out)

    return run


def _record_batch(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows))
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "start", "kind", "record"])


def load_dataset(spark: SparkSession, path: str, required=("TEXT",), **kw) -> DataFrame:
    """SRC2: scan and check required columns before any job; any failure -> ValueError."""
    try:
        df = read_corpus_csv(spark, path, **kw) if path.lower().endswith(".csv") else spark.read.parquet(path)
        missing = [c for c in required if c not in df.columns]
        if missing:
            raise ValueError(f"columns {missing} are missing in {path}")
        return df
    except Exception as e:  # noqa: BLE001 - any failure counts as a bad dataset
        raise ValueError(f"cannot read {path}: {e}") from e


def csv_to_parquet(spark: SparkSession, csv_path: str, out_path: str, id_col: str = "doc_id",
                   **kw) -> DataFrame:
    """Read the CSV once, attach a stable row id, write Parquet; return the Parquet scan."""
    df = read_corpus_csv(spark, csv_path, **kw)
    df.withColumn(id_col, F.monotonically_increasing_id()).write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def read_table(spark: SparkSession, folder: str, name: str, spread: bool = False) -> DataFrame:
    """SRC3: one Parquet table of the corpus folder.

    ``spread``: for CPU-heavy text work, a scan that yields fewer splits than the cluster
    has cores (a small file with one row group) is spread round-robin over the cores.
    Large inputs already scan as many splits and are left alone (no shuffle).
    """
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread_wide(df) if spread else df


def read_word_vectors(spark: SparkSession, path: str, word: str = "word", vector: str = "vector") -> DataFrame:
    """SRC4: pretrained vectors stored as Parquet (word string, vector array<float>)."""
    return spark.read.parquet(path).select(word, vector)


def save_bucketed(df: DataFrame, table: str, key: str = "doc_id", buckets: int = 512,
                  path: str | None = None) -> DataFrame:
    """Write a corpus table bucketed and sorted by ``key`` so that later joins on the key
    (documents x labels, answers x actual) are co-located: no shuffle of the text.
    Both sides of a join must use the same bucket count."""
    w = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return df.sparkSession.table(table)
