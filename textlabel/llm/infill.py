"""Fill-in-the-middle rearrangement of whole texts, as one pyarrow.compute pipeline, and its inverse.

A text is cut into units (code points, or lines) and at two places drawn from a digest of its key: prefix, middle and suffix are written
as ``<P>prefix<S>suffix<M>middle`` (psm) or ``<S>suffix<P>prefix<M>middle`` (spm), or the text stays as it is (plain). For each batch: the
bytes of the texts are split into units, held as list arrays with a list a row; the lists are flattened with their parents' indices; an
ordinal within its text is computed for every unit; units are filtered by role (prefix, middle, suffix); the lists are rebuilt and
joined to pieces. No step looks at one row or unit by itself.

Memory: a batch is worked through in windows of ``WINDOW`` bytes whatever the length of its texts (a unit that is longer makes a longer
window), so that beside the text and its output only a window's arrays are held.
Null text is the empty text; an empty text, one that contains a sentinel, and the share that ``rate`` leaves out are plain. A null key
draws as the empty key. Rows may repeat (equal keys draw alike); an empty table gives no rows; no other column is read but those of
``carry``, and ``prefix`` goes before the names of the outputs where they would clash. Ties do not occur: equal cuts make an empty piece.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

SENTINELS = ("<P>", "<S>", "<M>")
#: bytes of text whose units are laid out at a time, and bytes of the texts of a slice
WINDOW, SLICE = 1 << 18, 1 << 20
UNITS = ("char", "line")


def draws(key, seed: int = 1):
    """The first four 8-digit groups of the hex sha256 of ``seed:key``, as an array of longs."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


def _checked(sentinels) -> tuple[str, str, str]:
    """The sentinels, if every rearranged text can be told apart again: none empty, equal to or the start of another, and none with the
    first character of a sentinel inside it (so that a piece and a sentinel never make another sentinel where they meet)."""
    p, s, m = sentinels
    if not all(sentinels) or any(a != b and b.startswith(a) for a in sentinels for b in sentinels) or len(set(sentinels)) < 3:
        raise ValueError("sentinels must be three different strings, none the start of another")
    if any(c[0] in x[1:] for c in sentinels for x in sentinels):
        raise ValueError("a sentinel must not hold the first character of one past its start")
    return p, s, m


def _modulo(a: pa.Array, m: pa.Array) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, m), m))


def _counted(texts: pa.Array, unit: str) -> pa.Array:
    if unit == "char":
        return pc.cast(pc.utf8_length(texts), pa.int64())
    open_end = pc.and_(pc.greater(pc.binary_length(texts), 0), pc.invert(pc.ends_with(texts, "\n")))
    return pc.add(pc.cast(pc.count_substring(texts, "\n"), pa.int64()), pc.cast(open_end, pa.int64()))


def _window_end(data: bytes | memoryview, start: int, unit: str, window: int) -> int:
    """The last start of a unit at most ``window`` bytes on, or the next one if there is none."""
    end = start + window
    if end >= len(data):
        return len(data)
    if unit == "char":
        while data[end] & 0xC0 == 0x80:
            end -= 1
        return end
    return data.rfind(b"\n", start, end) + 1 or data.find(b"\n", end) + 1 or len(data)


def _offsets(counts: pa.Array) -> pa.Array:
    return pc.cast(pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(counts)]), pa.int32())


def cut_pieces(texts: pa.Array, low: pa.Array, high: pa.Array, unit: str = "char", window: int = WINDOW) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Prefix, middle and suffix of every text: the units before ``low``, from there to before ``high``, and the rest."""
    rows = len(texts)
    sizes = pc.cast(pc.binary_length(texts), pa.int64())
    borders = np.concatenate([[0], np.cumsum(sizes.to_numpy(zero_copy_only=False))]).astype(np.int64)
    raw = texts.buffers()
    first = int(np.frombuffer(raw[1], np.int32)[texts.offset]) if raw[1] else 0
    data = memoryview(raw[2])[first:first + int(borders[-1])] if raw[2] else memoryview(b"")
    if unit == "line":
        data = bytes(data)
    past = pa.array(np.zeros(rows, np.int64))  # units of each row in the windows before
    made: list[list[pa.Array]] = [[], [], []]
    start = 0
    while start < len(data) or not made[0]:
        end = _window_end(data, start, unit, window)
        held = np.frombuffer(data[start:end], np.uint8)
        clipped = np.clip(borders, start, end) - start
        if unit == "char":
            begins = (held & 0xC0) != 0x80
        else:
            begins = np.concatenate([[True], held[:-1] == 10])[:len(held)]
            begins[clipped[:-1][clipped[:-1] < len(held)]] = True
        at = pa.array(np.append(np.flatnonzero(begins), len(held)).astype(np.int32))
        units = pa.StringArray.from_buffers(len(at) - 1, at.buffers()[1], pa.py_buffer(held))
        before = pa.array(np.concatenate([[0], np.cumsum(begins)]))
        lists = pa.ListArray.from_arrays(pc.cast(pc.take(before, pa.array(clipped)), pa.int32()), units)
        counts = pc.cast(pc.list_value_length(lists), pa.int64())
        parents, flat = pc.list_parent_indices(lists), pc.list_flatten(lists)
        origin = pc.subtract(pc.subtract(pc.cumulative_sum(counts), counts), past)
        ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(origin, parents))
        in_prefix = pc.less(ordinal, pc.take(low, parents))
        in_suffix = pc.greater_equal(ordinal, pc.take(high, parents))
        ends = [pc.min_element_wise(pc.max_element_wise(pc.subtract(x, past), 0), counts) for x in (low, high)]
        for out, keep, n in zip(made, (in_prefix, pc.invert(pc.or_(in_prefix, in_suffix)), in_suffix),
                                (ends[0], pc.subtract(ends[1], ends[0]), pc.subtract(counts, ends[1]))):
            out.append(pc.binary_join(pa.ListArray.from_arrays(_offsets(n), pc.filter(flat, keep)), ""))
        past, start = pc.add(past, counts), end
    return tuple(out[0] if len(out) == 1 else pc.binary_join_element_wise(*out, "") for out in made)


def fill_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", rate: int = 90, spm: int = 20, seed: int = 1,
                sentinels: tuple[str, str, str] = SENTINELS, unit: str = "char", carry=(), prefix: str = "") -> DataFrame:
    """(key, *carry, n, form, prefix_chars, middle_chars, output) for every row: ``rate`` per cent of the texts are rearranged, ``spm`` per
    cent of those with the suffix first. n counts units; the lengths are code points, null for plain texts."""
    p, s, m = _checked(sentinels)
    if unit not in UNITS:
        raise ValueError(f"unit is one of {', '.join(UNITS)}, not {unit}")
    src = docs.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"), draws(key, seed).alias("_draws"),
                      *[F.col(c) for c in carry if c != key])
    outputs = [T.StructField(prefix + name, kind) for name, kind in (("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()),
                                                                     ("middle_chars", T.LongType()), ("output", T.StringType()))]
    schema = T.StructType([src.schema[0], *src.schema[3:], *outputs])
    names = schema.names

    def arranged(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = pc.cast(batch.column(1), pa.string())
        h = [pc.list_element(batch.column(2), i) for i in range(4)]
        n = _counted(texts, unit)
        size = pc.add(n, 1)
        a, b = _modulo(h[0], size), _modulo(h[1], size)
        hundred = pa.array(np.full(len(n), 100))
        plain = pc.or_(pc.equal(n, 0), pc.greater_equal(_modulo(h[2], hundred), rate))
        for x in (p, s, m):
            plain = pc.or_(plain, pc.match_substring(texts, x))
        suffix_first = pc.less(_modulo(h[3], hundred), spm)
        zero = pa.scalar(0, pa.int64())
        low = pc.if_else(plain, zero, pc.min_element_wise(a, b))
        high = pc.if_else(plain, zero, pc.max_element_wise(a, b))
        before, middle, after = cut_pieces(texts, low, high, unit)  # of a plain text all is suffix
        psm = pc.binary_join_element_wise(p, before, s, after, m, middle, "")
        output = pc.if_else(plain, texts, pc.if_else(suffix_first, pc.binary_join_element_wise(s, after, p, before, m, middle, ""), psm))
        form = pc.if_else(plain, "plain", pc.if_else(suffix_first, "spm", "psm"))
        none = pa.scalar(None, pa.int64())
        return [n, form, *[pc.if_else(plain, none, pc.cast(pc.utf8_length(x), pa.int64())) for x in (before, middle)], output]

    def run(parts):
        for batch in parts:
            for rows in slices(batch, SLICE):
                yield pa.RecordBatch.from_arrays([rows.column(0), *rows.columns[3:], *arranged(rows)], names=names)

    return src.mapInArrow(run, schema)


def restore_text(df: DataFrame, key: str = "doc_id", output: str = "output", form: str = "form", sentinels: tuple[str, str, str] = SENTINELS,
                 carry=(), name: str = "text") -> DataFrame:
    """(key, *carry, text): the text from its rearranged form, exactly. The first sentinel that ends a piece ends it: texts that hold a
    sentinel themselves are plain."""
    p, s, m = _checked(sentinels)
    src = df.select(F.col(key), F.coalesce(F.col(output), F.lit("")).alias("_output"), F.col(form).alias("_form"), *[F.col(c) for c in carry if c != key])
    schema = T.StructType([src.schema[0], *src.schema[3:], T.StructField(name, T.StringType())])
    names = schema.names

    def split(texts: pa.Array, at: str) -> tuple[pa.Array, pa.Array]:
        parts = pc.split_pattern(texts, at, max_splits=1)
        return pc.list_element(parts, 0), pc.list_element(parts, 1)

    def joined(batch: pa.RecordBatch) -> pa.Array:
        out = pc.cast(batch.column(1), pa.string())
        for name_, opening, inner in (("psm", p, s), ("spm", s, p)):
            chosen = pc.fill_null(pc.equal(batch.column(2), name_), False)
            first, rest = split(split(pc.filter(out, chosen), opening)[1], inner)
            second, middle = split(rest, m)
            whole = pc.binary_join_element_wise(*((first, middle, second) if name_ == "psm" else (second, middle, first)), "")
            out = pc.replace_with_mask(out, chosen, whole)
        return out

    def run(parts):
        for batch in parts:
            for rows in slices(batch, SLICE):
                yield pa.RecordBatch.from_arrays([rows.column(0), *rows.columns[3:], joined(rows)], names=names)

    return src.mapInArrow(run, schema)
