"""SentencePiece encoding and decoding by suffix-array matching (BPE models).

A text is normalised as the model asks (spaces become U+2581, one is put in front) and falls into
segments, each a run of U+2581 and the characters up to the next one or the end of the line. No piece of
the model crosses such a border, so segments are encoded on their own, each distinct one of a batch once:

1. the new distinct segments are concatenated and indexed by a suffix array that is sorted as deep as
   the longest piece is long,
2. every piece is binary-searched for the range of suffixes it begins,
3. the ranges are the edges (position, length, piece) of the lattice; they are laid out by position,
4. the lattice is relaxed in the order of the model's scores: of two neighbouring symbols that an edge
   spans, the best edge (the leftmost of equals) joins them first, all segments side by side. That is
   what a BPE model defines; shortest-path relaxation over the same edges would be a unigram model.

Characters on no chosen edge become the byte pieces of their UTF-8 bytes. Of equal scores the leftmost edge joins first.

Memory: texts are taken by ``SLICE`` bytes, new segments by ``INDEXED`` characters (a longer one is indexed in windows that overlap by the
longest piece), and a worker remembers at most 2 x ``REMEMBERED`` bytes. A segment longer than all that, a text without blanks,
takes about 130 bytes a character while it is encoded.

``encode_pieces``: null and empty texts give an empty list; other columns but those of ``carry`` are not read, whatever their names; rows
may repeat; an empty table gives no rows. ``decode_pieces``: null and empty lists give an empty text, null ids are left out, and ids that
the model does not have raise ``IndexError``.
Encoding then decoding returns the text, but for U+2581, which the model holds to be a space.
"""

from __future__ import annotations

import codecs
import heapq
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import id_and, int_lists, slices, texts_of

SPACE = "▁"
#: a segment longer than this is relaxed with a heap instead of side by side with others
LONG = 48
#: bytes of distinct segments and their ids that a worker remembers, in each of two generations
REMEMBERED = 112 << 20
#: characters of new segments that are indexed at once; bytes of texts, and ids, that are worked on at once
INDEXED, SLICE, IDS = 1 << 18, 1 << 21, 1 << 18

_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


def piece_path(path: str | None = None) -> str:
    """The model's place; the public tokenizer package's copy unless a path is given."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def load_model(path: str) -> "PieceModel":
    return PieceModel(path)


class PieceModel:
    """Pieces, scores and byte pieces of a model file, read through the public library."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        scores = np.array([sp.get_score(i) for i in range(n)], dtype=np.float32)
        self.byte_id = np.zeros(256, dtype=np.int32)
        self.raw: list[bytes] = [p.replace(SPACE, " ").encode() for p in self.pieces]
        normal = []
        for i, p in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte_id[int(p[3:-1], 16)] = i
                self.raw[i] = bytes([int(p[3:-1], 16)])
            elif sp.is_control(i):
                self.raw[i] = b""
            elif sp.is_unknown(i):
                self.raw[i] = " ⁇ ".encode()
            else:
                normal.append(i)
        if any(SPACE in self.pieces[i].lstrip(SPACE) or "\n" in self.pieces[i] for i in normal):
            raise ValueError("a piece crosses a word or line border: texts cannot be cut into segments")
        self.ids = np.array(normal, dtype=np.int32)
        self.depth = max(len(self.pieces[i]) for i in normal)
        # equal scores share a rank; rank 0 is the best
        self.rank = np.zeros(n, dtype=np.int32)
        self.rank[:] = np.unique(-scores, return_inverse=True)[1]
        width = self.depth
        self.codes = np.zeros((len(normal), width), dtype=np.uint32)
        for row, i in enumerate(normal):
            self.codes[row, : len(self.pieces[i])] = [ord(c) for c in self.pieces[i]]
        self.lengths = (self.codes > 0).sum(axis=1).astype(np.int64)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    # -- encoding ---------------------------------------------------------------------------------

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian int32 ids of each text."""
        split = [segments(t) for t in texts]
        known, older, new = self.known, self.older, []
        for w in set().union(*split).difference(known):
            if (ids := older.get(w)) is not None:
                self._remember(w, ids)
            else:
                new.append(w)
        for group in _groups(new, INDEXED):
            for w, ids in zip(group, self.encode_segments(group)):
                self._remember(w, ids)
        out = [b"".join(map(known.__getitem__, words)) for words in split]
        if self.held > REMEMBERED:  # what has not been seen again by the next time is forgotten
            self.known, self.older, self.held = {}, known, 0
        return out

    def _remember(self, word: str, ids: bytes) -> None:
        self.known[word] = ids
        self.held += 200 + 4 * len(word) + len(ids)  # about what the two objects and their entry take

    def encode_segments(self, segs: list[str]) -> list[bytes]:
        text, starts, lengths = _concatenated(segs)
        edges = self.lattice(text)
        ids: list[bytes] = [b""] * len(segs)  # an empty segment has none
        short = np.flatnonzero(lengths <= LONG)
        left, right, of = _relaxed_side_by_side(edges, self.rank, starts[short], lengths[short])
        flat, owner = self.symbol_ids(edges, text, left, right, of)
        bounds = np.searchsorted(owner, np.arange(len(short) + 1))
        data = flat.astype("<i4").tobytes()
        for k, s in enumerate(short.tolist()):
            ids[s] = data[4 * bounds[k]: 4 * bounds[k + 1]]
        for s in np.flatnonzero(lengths > LONG).tolist():
            lo, hi = _relaxed_with_heap(edges, self.rank, int(starts[s]), int(lengths[s]))
            ids[s] = self.symbol_ids(edges, text, lo, hi, np.zeros(len(lo), np.int64))[0].astype("<i4").tobytes()
        return ids

    def lattice(self, text: np.ndarray) -> np.ndarray:
        """Piece id + 1 of the edge that begins at each position with each length (0: none)."""
        edges = np.zeros((len(text), self.depth + 1), dtype=np.int32)
        for start in range(0, len(text), 2 * INDEXED):  # one window, but for a long segment
            window = text[start: start + 2 * INDEXED + self.depth]
            order, keys, code_of = suffix_array(window, self.depth)
            low, high, present = _piece_keys(self.codes, self.lengths, self.depth, code_of, len(keys))
            first, last = _search(keys, low, False), _search(keys, high, True)
            n = np.where(present, last - first, 0)
            rows = np.repeat(np.arange(len(n)), n)
            at = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)]
            own = at < 2 * INDEXED
            edges[start + at[own], self.lengths[rows[own]]] = self.ids[rows[own]] + 1
        return edges

    def symbol_ids(self, edges, text, left, right, of):
        """Ids of symbols [left, right) in order and the segment of each id; byte pieces where no piece is."""
        span = right - left
        piece = np.where(span < edges.shape[1], edges[left, np.minimum(span, edges.shape[1] - 1)], 0)
        if piece.all():
            return piece - 1, of
        chars, which = np.unique(text[left[piece == 0]], return_inverse=True)  # such a symbol is one character
        spelt = [self.byte_id[list(chr(c).encode("utf-8", "surrogatepass"))] for c in chars.tolist()]
        sizes = np.array([len(x) for x in spelt])
        times = np.ones(len(piece), dtype=np.int64)
        times[piece == 0] = sizes[which]
        out, owner = np.repeat(piece - 1, times), np.repeat(of, times)
        out[np.repeat(piece == 0, times)] = np.concatenate([spelt[w] for w in which.tolist()])
        return out, owner

    # -- decoding ---------------------------------------------------------------------------------

    def decode(self, ids: list[int | None]) -> str:
        ids = [i for i in ids if i is not None]
        if ids and not 0 <= min(ids) <= max(ids) < len(self.raw):
            raise IndexError(f"the model has the ids 0 to {len(self.raw) - 1}, not {min(ids)} to {max(ids)}")
        data = b"".join(map(self.raw.__getitem__, ids))
        first = next((i for i in ids if self.raw[i]), None)
        text = data.decode("utf-8", "each_byte")
        return text[1:] if first is not None and self.pieces[first].startswith(SPACE) else text


def segments(text: str) -> list[str]:
    """The segments of a text, dummy prefix included."""
    if not text:
        return []
    if "  " in text or SPACE in text or text[0] == " ":
        return _SEGMENT.findall(SPACE + text.replace(" ", SPACE))
    return (SPACE + text.replace(" ", " " + SPACE).replace("\n", " \n ")).split(" ")


def _groups(items: list[str], chars: int):
    group, n = [], 0
    for s in items:
        group.append(s)
        n += len(s)
        if n >= chars:
            yield group
            group, n = [], 0
    if group:
        yield group


def _concatenated(segs: list[str]):
    """Code points of all segments, each followed by a 0 that no piece holds, with starts and lengths."""
    lengths = np.fromiter(map(len, segs), dtype=np.int64, count=len(segs))
    starts = np.cumsum(lengths + 1) - lengths - 1
    joined = "\0".join(segs) + "\0"
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), starts, lengths


def suffix_array(text: np.ndarray, depth: int):
    """Positions sorted by their next ``depth`` characters, the sorted keys (one or more uint64 columns
    that hold the characters, packed), and the code of each character."""
    alphabet, codes = np.unique(text, return_inverse=True)
    code_of = dict(zip(alphabet.tolist(), range(1, len(alphabet) + 1)))
    codes = (codes + 1).astype(np.uint64)
    codes[text == 0] = 0
    bits = max(1, int(len(alphabet) + 1).bit_length())
    per = 63 // bits
    words = -(-depth // per)
    padded = np.zeros(len(text) + words * per, dtype=np.uint64)
    padded[: len(text)] = codes
    keys = []
    for w in range(words):
        key = np.zeros(len(text), dtype=np.uint64)
        for j in range(per):
            at = w * per + j
            key = (key << np.uint64(bits)) | padded[at: at + len(text)] if at < depth else key << np.uint64(bits)
        keys.append(key)
    order = np.argsort(keys[0], kind="stable") if words == 1 else np.lexsort(keys[::-1])
    return order, [k[order] for k in keys], (code_of, bits, per)


def _piece_keys(codes, lengths, depth, packing, words):
    """The smallest and the largest key of the suffixes that begin with each piece, and whether the
    text has all characters of the piece."""
    code_of, bits, per = packing
    values, where = np.unique(codes, return_inverse=True)
    mapped = np.array([0 if v == 0 else code_of.get(int(v), -1) for v in values], dtype=np.int64)[where].reshape(codes.shape)
    present = (mapped >= 0).all(axis=1)
    mapped = np.maximum(mapped, 0).astype(np.uint64)
    ones = np.uint64((1 << bits) - 1)
    low, high = [], []
    for w in range(words):
        a, b = (np.zeros(len(codes), dtype=np.uint64) for _ in range(2))
        for j in range(per):
            at = w * per + j
            a, b = a << np.uint64(bits), b << np.uint64(bits)
            if at < depth:
                a = a | mapped[:, at]
                b = b | np.where(at < lengths, mapped[:, at], ones)
        low.append(a)
        high.append(b)
    return low, high, present


def _search(keys, wanted, with_equal: bool) -> np.ndarray:
    """For each wanted key the number of sorted keys below it, equal ones too if asked (all pieces at once)."""
    n = len(keys[0])
    lo = np.zeros(len(wanted[0]), dtype=np.int64)
    hi = np.full(len(wanted[0]), n, dtype=np.int64)
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        at = np.minimum(mid, n - 1)
        less, same = np.zeros(len(lo), bool), np.ones(len(lo), bool)
        for have, want in zip(keys, wanted):
            h = have[at]
            less |= same & (h < want)
            same &= h == want
        less |= same & with_equal
        lo = np.where(open_ & less, mid + 1, lo)
        hi = np.where(open_ & ~less, mid, hi)


def _relaxed_side_by_side(edges, rank, starts, lengths):
    """Symbols [left, right) and their segment after all joins; one join a round in every segment."""
    of = np.repeat(np.arange(len(starts)), lengths)
    left = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)
    right = left + 1
    done = []
    worst = np.int64(1) << 40
    while len(of):
        span = np.empty(len(of), dtype=np.int64)
        span[:-1] = right[1:] - left[:-1]
        span[-1] = 0
        same = np.empty(len(of), dtype=bool)
        same[:-1] = of[1:] == of[:-1]
        same[-1] = False
        fits = same & (span < edges.shape[1])
        piece = np.where(fits, edges[left, np.where(fits, span, 0)], 0)
        # rank first, then place: the least is the best edge, the leftmost of equals
        cost = np.where(piece > 0, rank[piece - 1].astype(np.int64), worst)
        heads = np.flatnonzero(np.r_[True, ~same[:-1]])
        best = np.minimum.reduceat(cost, heads)
        counts = np.diff(np.r_[heads, len(of)])
        is_best = (cost == np.repeat(best, counts)) & (cost < worst)
        first = np.flatnonzero(is_best)
        first = first[np.r_[True, of[first[1:]] != of[first[:-1]]]] if len(first) else first
        finished = np.repeat(best == worst, counts)
        if finished.any():
            done.append((left[finished], right[finished], of[finished]))
        right[first] = right[np.minimum(first + 1, len(of) - 1)]
        keep = ~finished
        keep[first + 1] = False
        left, right, of = left[keep], right[keep], of[keep]
    if not done:
        return (np.zeros(0, np.int64),) * 3
    left, right, of = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(left, kind="stable")
    return left[order], right[order], of[order]


def _relaxed_with_heap(edges, rank, start: int, length: int):
    """The same joins for one long segment: a heap of edges and a chain of symbols."""
    right = np.arange(1, length + 1)  # where the symbol at each place ends; 0: no symbol begins there
    before = np.arange(-1, length - 1)
    depth = edges.shape[1]
    bits = max(1, length.bit_length())

    def edge(i):
        """The join of the symbol at i with the next one, as one number: rank, then place."""
        j = int(right[i])
        if j >= length:
            return None
        k = int(right[j])
        p = edges[start + i, k - i] if k - i < depth else 0
        return (int(rank[p - 1]) << bits | i) if p else None

    heap = [e for e in map(edge, range(length)) if e is not None]
    heapq.heapify(heap)
    while heap:
        e = heapq.heappop(heap)
        i = e & (1 << bits) - 1
        if not right[i] or edge(i) != e:  # joined with another meanwhile
            continue
        j = int(right[i])
        k = int(right[j])
        right[i], right[j] = k, 0
        if k < length:
            before[k] = i
        for x in (edge(int(before[i])) if i else None, edge(i)):
            if x is not None:
                heapq.heappush(heap, x)
    left = np.flatnonzero(right)
    return left + start, right[left] + start


def encode_pieces(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, *carry, ids array<int>, n_tokens, ids_crc32) of every whole text."""
    path = piece_path(path)
    src = id_and(df, key, text, *carry)
    fields = [src.schema[0], *src.schema[2:], T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
              T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]

    def run(parts):
        model = load_model(path)
        for batch in parts:
            for rows in slices(batch, SLICE):
                got = model.encode(texts_of(rows))
                values = np.frombuffer(b"".join(got), dtype="<i4")
                lengths = [len(g) // 4 for g in got]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *rows.columns[2:], int_lists(values, lengths),
                     pa.array(lengths, pa.int64()), pa.array([zlib.crc32(g) for g in got], pa.int64())],
                    names=[f.name for f in fields])

    return src.mapInArrow(run, T.StructType(fields))


def decode_pieces(df: DataFrame, key: str = "doc_id", ids: str = "ids", path: str | None = None,
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, *carry, text) of every whole list of ids."""
    path = piece_path(path)
    src = id_and(df, key, ids, *carry)
    fields = [src.schema[0], *src.schema[2:], T.StructField("text", T.StringType())]

    def run(parts):
        model = load_model(path)
        for batch in parts:
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1] if len(ends) else 0, IDS), side="left")).tolist()
            for start, end in zip(cuts, [*cuts[1:], batch.num_rows]):
                rows = batch.slice(start, end - start)
                texts = [model.decode(x or []) for x in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column(0), *rows.columns[2:], pa.array(texts, pa.string())],
                                                 names=[f.name for f in fields])

    return src.mapInArrow(run, T.StructType(fields))
