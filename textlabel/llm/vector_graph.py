"""Near-duplicate vectors by a robust-pruned flat graph that is built in overlapping shards.

1. Vectors are scaled to length 1 in double precision; equal ones are one node (copies cost a row, not a link each).
2. At most ``CENTRES`` nodes, chosen by hash, are shard centres. Each node is stored in its ``COPIES`` nearest shards; shards beyond
   ``SHARD`` nodes are dealt to parts, and a centre's share of the nodes only changes their number.
3. Build: in each part every node's nearest nodes are robust-pruned to at most ``DEGREE`` neighbours: a candidate is dropped if a kept
   neighbour is, by a factor, nearer to it than the node is. The adjacency lists that a node has in all its parts are united, links
   both ways, and each part has the united lists of its members: neighbours from other parts are added to its nodes. A part sends
   each other part what their common members have in it; the neighbours themselves go as codes, a byte a component and the length of
   what the rounding takes off, which bounds the error of every dot product.
4. Search: each node is looked for in its ``PROBES`` nearest shards, all parts of them. From the medoids of the graph's components (a
   group of near copies may have no link to the rest) a greedy search goes to the neighbours nearest to the query, a beam at a time;
   it then expands the range: neighbours of all nodes within the range are visited until no new node is in range.
5. Verify: a pair is linked if the dot product of the unit vectors in double precision is >= ``similarity``; where a code's bound
   leaves this open, the pair's vectors are fetched.
6. ``true_links``: all links of a hash sample of nodes, against all nodes; the sample grows until it holds ``AUDIT_LINKS`` links or
   every node. If the search has found less than ``recall`` of them it goes on to twice as many shards, at last to all of
   them; if that is not enough either, each node is compared with all nodes of its width, block by block.

``vector_duplicates``: one row for each row of the table. n_links counts rows, copies included. A vector that is null, empty, zero
or holds null or non-finite components has no links and is alone in its component. Vectors of different widths
are never linked. Rows may repeat; a null id is never the smallest of its component. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import components
from .vectors import matrix, packed, pivots, usable

CENTRES = 512
SHARD = 1500
COPIES = 2
PROBES = 6
DEGREE = 24
POOL = 64
ALPHA = 1.2
BEAM = 24
#: slack of the range that is expanded: neighbours just outside lead to those inside
SLACK = 0.05
#: queries that walk a part side by side
SIDE_BY_SIDE = 1024
#: blocks of queries that a shard takes in one task; a shard that is asked by more has its parts in several
LANE = 8
#: the audit starts with so many nodes, and goes on, at most AUDIT_BLOCK nodes at once, until they have so many true links
AUDIT_NODES, AUDIT_LINKS, AUDIT_BLOCK = 200, 500, 4096


def unit(x: np.ndarray) -> list:
    """Rows scaled to length 1; None for a zero row."""
    top = np.abs(x).max(axis=1, keepdims=True)
    zero = top[:, 0] == 0
    x = x / np.where(top == 0, 1, top)
    x = x / np.where(zero[:, None], 1, np.sqrt((x * x).sum(axis=1, keepdims=True)))
    return [None if z else r + 0.0 for z, r in zip(zero, x)]


def robust_pruned(x: np.ndarray, degree: int = DEGREE, pool: int = POOL, alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray]:
    """Links (from, to) of the pruned graph over the rows of x."""
    n = len(x)
    out_from, out_to = [], []
    for start in range(0, n, 512):
        s = x[start: start + 512] @ x.T
        s[np.arange(len(s)), np.arange(start, start + len(s))] = -np.inf
        take = min(pool, n - 1)
        near = np.argpartition(-s, take - 1, axis=1)[:, :take] if take < n - 1 else np.argsort(-s, axis=1)[:, :take]
        order = np.argsort(-np.take_along_axis(s, near, axis=1), axis=1, kind="stable")
        near = np.take_along_axis(near, order, axis=1)
        d = np.sqrt(np.maximum(0, 2 - 2 * np.take_along_axis(s, near, axis=1)))
        between = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("iad,ibd->iab", x[near], x[near], optimize=True)))
        alive = np.ones(near.shape, dtype=bool)
        kept = np.zeros(near.shape, dtype=bool)
        for j in range(near.shape[1]):  # the nearest that is still alive is kept and drops those it covers
            now = alive[:, j] & (kept.sum(axis=1) < degree)
            kept[:, j] = now
            alive &= ~(now[:, None] & (alpha * between[:, j] <= d))
        i, j = np.nonzero(kept)
        out_from.append(i + start)
        out_to.append(near[i, j])
    return np.concatenate(out_from), np.concatenate(out_to)


def neighbour_table(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of neighbours, links both ways, padded with the node itself."""
    a, b = np.r_[a, b], np.r_[b, a]
    both = np.unique(a * n + b)
    a, b = both // n, both % n
    counts = np.bincount(a, minlength=n)
    table = np.repeat(np.arange(n)[:, None], max(1, counts.max(initial=1)), axis=1)
    table[a, np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts)] = b
    return table


def medoids(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The medoid of each connected component of the graph."""
    label = np.arange(len(x))
    while True:
        low = label[table].min(axis=1)
        low = np.minimum(low, low[low])
        if (low == label).all():
            break
        label = low
    order = np.argsort(label, kind="stable")
    heads = np.flatnonzero(np.r_[True, np.diff(label[order]) > 0])
    return np.array([own[(x[own] @ x[own].mean(axis=0)).argmax()] for own in np.split(order, heads[1:])])


def range_search(x: np.ndarray, table: np.ndarray, q: np.ndarray, similarity: float, off: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, node, dot product) within the range, found from the medoids of the graph's components. ``off`` bounds the error of
    each node's dot products: what may be in the range is in it."""
    n, m = len(x), len(q)
    off = np.zeros(n) if off is None else off
    starts = medoids(x, table)
    seen = np.zeros((m, n), dtype=bool)
    seen[:, starts] = True
    first = q @ x[starts].T
    found = [(np.repeat(np.arange(m), len(starts)), np.tile(starts, m), first.ravel())]
    nearest = np.argsort(-first, axis=1, kind="stable")[:, :BEAM]
    beam = np.full((m, BEAM), starts[0])
    score = np.full((m, BEAM), -np.inf)
    walked = np.ones((m, BEAM), dtype=bool)
    beam[:, : nearest.shape[1]] = starts[nearest]
    score[:, : nearest.shape[1]] = np.take_along_axis(first, nearest, axis=1)
    walked[:, : nearest.shape[1]] = False

    def visit(queries: np.ndarray, nodes: np.ndarray):
        """New (query, node, score) among the neighbours of the nodes; each is visited once."""
        near = table[nodes]
        fresh = ~seen[queries[:, None], near]
        a, j = np.nonzero(fresh)
        pair = np.unique(queries[a] * np.int64(n) + near[a, j])
        a, b = pair // n, pair % n
        seen[a, b] = True
        s = np.concatenate([np.einsum("ij,ij->i", q[a[i: i + 65536]], x[b[i: i + 65536]]) for i in range(0, len(a), 65536)] or [np.zeros(0)])
        found.append((a, b, s))
        return a, b, s

    while True:
        best = np.where(walked, -np.inf, score).argmax(axis=1)
        rows = np.flatnonzero(~walked[np.arange(m), best])
        if not len(rows):
            break
        walked[rows, best[rows]] = True
        a, b, s = visit(rows, beam[rows, best[rows]])
        if not len(a):
            continue
        counts = np.bincount(a, minlength=m)
        wide = int(counts.max())
        place = np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts)
        more, more_score, more_walked = np.zeros((m, wide), beam.dtype), np.full((m, wide), -np.inf), np.ones((m, wide), bool)
        more[a, place], more_score[a, place], more_walked[a, place] = b, s, False
        all_score = np.concatenate([score, more_score], axis=1)
        top = np.argsort(-all_score, axis=1, kind="stable")[:, :BEAM]
        beam = np.take_along_axis(np.concatenate([beam, more], axis=1), top, axis=1)
        walked = np.take_along_axis(np.concatenate([walked, more_walked], axis=1), top, axis=1)
        score = np.take_along_axis(all_score, top, axis=1)
    # the range grows from every node inside it, whether walked before or not
    a, b, s = (np.concatenate(v) for v in zip(*found))
    inside = s >= similarity - SLACK - off[b]
    a, b = a[inside], b[inside]
    while len(a):
        parts = [visit(a[i: i + 20_000], b[i: i + 20_000]) for i in range(0, len(a), 20_000)]
        a, b, s = (np.concatenate(v) for v in zip(*parts))
        inside = s >= similarity - SLACK - off[b]
        a, b = a[inside], b[inside]
    a, b, s = (np.concatenate(v) for v in zip(*found))
    hit = s >= similarity - off[b]
    return a[hit], b[hit], s[hit]


def _routes(nodes: DataFrame, centres, count: int, first: int = 0) -> DataFrame:
    """(node, shard) for the ``count`` nearest shards of each node, but for the ``first`` nearest."""

    def run(batches):
        for batch in batches:
            column = batch.column(0)
            widths = np.array([len(x) for x in column.to_pylist()])
            for w in np.unique(widths):
                at = column.take(pa.array(np.flatnonzero(widths == w)))
                names, points = centres.value[int(w)]
                near = np.argsort(-(matrix(at) @ points.T), axis=1, kind="stable")[:, first:count]
                yield pa.RecordBatch.from_arrays([at.take(pa.array(np.repeat(np.arange(len(at)), near.shape[1]))), pa.array(names[near.ravel()])], names=["node", "shard"])

    return nodes.select("node").mapInArrow(run, "node binary, shard int")


def _built(group: pd.DataFrame) -> pd.DataFrame:
    """The pruned graph of one part as rows (node, adjacent nodes by position)."""
    group = group.sort_values("node", ignore_index=True)
    x = np.array([np.frombuffer(v, dtype=np.float64) for v in group["node"]])
    a, b = robust_pruned(x) if len(x) > 1 else (np.zeros(0, int), np.zeros(0, int))
    return pd.DataFrame({"shard": group["shard"].iloc[0], "part": group["part"].iloc[0], "members": [group["node"].tolist()], "a": [a.tolist()], "b": [b.tolist()]})


def _names(nodes: list[bytes]) -> list[bytes]:
    """What a node is called in links: 12 bytes of the md5 of its vector, as ``_named`` has it."""
    return [hashlib.md5(v).digest()[:12] for v in nodes]


def _named(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("name", F.unhex(F.substring(F.md5("node"), 1, 24)))


def code_type(width: int) -> np.dtype:
    """A neighbour from another part: name, step of a component, the length of what rounding takes off (rounded up), components in steps."""
    return np.dtype([("name", "u1", 12), ("step", "<f4"), ("off", "<f4"), ("x", "i1", width)])


def coded(x: np.ndarray, names: list[bytes]) -> list[bytes]:
    """Codes of unit vectors."""
    out = np.zeros(len(x), code_type(x.shape[1]))
    out["name"] = np.frombuffer(b"".join(names), np.uint8).reshape(len(x), 12)
    out["step"] = np.abs(x).max(axis=1) / 127
    step = out["step"].astype(float)[:, None]
    out["x"] = np.clip(np.rint(x / step), -127, 127)
    out["off"] = np.nextafter(np.sqrt(((x - out["x"] * step) ** 2).sum(axis=1)).astype("<f4"), np.float32(np.inf))
    return [r.tobytes() for r in out]


def decoded(codes: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(vectors, bounds of the error of their dot products with unit vectors, names) of codes."""
    out = np.frombuffer(b"".join(codes), code_type(width))
    return out["x"] * out["step"].astype(float)[:, None], out["off"].astype(float), [r.tobytes() for r in out["name"]]


def _united(built: DataFrame) -> DataFrame:
    """The parts with the united lists of their members. Neighbours from other parts come after a part's own members: as codes, after
    those that are members, or as members themselves where a vector is no longer than its code."""
    own = _named(built.select("shard", "part", F.explode("members").alias("node"))).select("name", F.struct("shard", "part").alias("home"))
    homes = own.groupBy("name").agg(F.collect_list("home").alias("homes")).filter(F.size("homes") > 1)
    common = (homes.select("name", "homes", F.explode("homes").alias("home")).groupBy("home.shard", "home.part")
              .agg(F.collect_list(F.struct("name", "homes")).alias("common")))

    def sent(parts):
        """For each other part: the links of the members that both have; what it does not have comes with a vector or code."""
        for batch in parts:
            for i in range(batch.num_rows):
                shard, part, members, a, b, shared = (batch.column(k)[i] for k in range(6))
                nodes, a, b = members.values.to_pylist(), a.values.to_numpy(), b.values.to_numpy()
                names = _names(nodes)
                place = {v: k for k, v in enumerate(names)}
                targets: dict[tuple, list[int]] = {}
                for one in shared.as_py():
                    for at in one["homes"]:
                        targets.setdefault((at["shard"], at["part"]), []).append(place[one["name"]])
                targets.pop((shard.as_py(), part.as_py()), None)
                width = len(nodes[0]) // 8
                wanted = coded(matrix(members.values), names) if code_type(width).itemsize < 8 * width else nodes
                for (to_shard, to_part), known in targets.items():
                    both = np.zeros(len(nodes), bool)
                    both[known] = True
                    link = both[a] | both[b]
                    ends, at = np.unique(np.r_[a[link], b[link]], return_inverse=True)
                    if len(ends):
                        yield pa.RecordBatch.from_pylist([{"shard": to_shard, "part": to_part, "names": b"".join(names[k] for k in ends),
                                                           "nodes": [None if both[k] else wanted[k] for k in ends],
                                                           "ends": at.astype("<i4").tobytes()}], schema=rows)

    rows = pa.schema([("shard", pa.int32()), ("part", pa.int64()), ("names", pa.binary()), ("nodes", pa.list_(pa.binary())), ("ends", pa.binary())])
    brought = (built.join(common, ["shard", "part"]).select("shard", "part", "members", "a", "b", "common")
               .mapInArrow(sent, "shard int, part long, names binary, nodes array<binary>, ends binary")
               .groupBy("shard", "part").agg(F.collect_list(F.struct("names", "nodes", "ends")).alias("brought")))

    def merged(parts):
        for batch in parts:
            for i in range(batch.num_rows):
                shard, part, members, a, b, brought_ = (batch.column(k)[i] for k in range(6))
                nodes = members.values.to_pylist()
                n, width = len(nodes), len(nodes[0])
                place = {v: k for k, v in enumerate(_names(nodes))}
                a, b = [a.values.to_numpy()], [b.values.to_numpy()]
                for one in brought_.as_py() or []:
                    names = [one["names"][k: k + 12] for k in range(0, len(one["names"]), 12)]
                    for name, node in zip(names, one["nodes"]):
                        if name not in place:  # a neighbour may come from several parts
                            place[name] = len(nodes)
                            nodes.append(node)
                    ends = np.array([place[v] for v in names])[np.frombuffer(one["ends"], "<i4")]
                    a.append(ends[: len(ends) // 2])
                    b.append(ends[len(ends) // 2:])
                n = n if len(nodes) > n and len(nodes[n]) != width else len(nodes)
                yield pa.RecordBatch.from_arrays([pa.array([shard.as_py()], pa.int32()), pa.array([part.as_py()], pa.int64()), pa.array([nodes[:n]], pa.list_(pa.binary())),
                                                  pa.array([np.concatenate(a)], pa.list_(pa.int64())), pa.array([np.concatenate(b)], pa.list_(pa.int64())),
                                                  pa.array([nodes[n:]], pa.list_(pa.binary()))], names=["shard", "part", "members", "a", "b", "codes"])

    return (built.join(brought, ["shard", "part"], "left").select("shard", "part", "members", "a", "b", "brought")
            .mapInArrow(merged, "shard int, part long, members array<binary>, a array<long>, b array<long>, codes array<binary>"))


def _pairs(left: list[bytes], right: list[bytes], a: np.ndarray, b: np.ndarray):
    """The distinct pairs (smaller name, larger name) of left[a] and right[b], a slice at a time; a node is not linked with itself."""
    names = sorted({*left, *right})
    number = {v: i for i, v in enumerate(names)}
    a, b = (np.array([number[v] for v in side], np.int64)[at] for side, at in ((left, a), (right, b)))
    pairs = np.unique(np.minimum(a, b)[a != b] * len(names) + np.maximum(a, b)[a != b])
    names = pa.array(names, pa.binary())
    for start in range(0, len(pairs), 20_000):
        some = pairs[start: start + 20_000]
        yield pa.RecordBatch.from_arrays([names.take(pa.array(x)) for x in (some // len(names), some % len(names))], names=["a", "b"])


def _links(found: DataFrame, nodes: DataFrame, shared, first: int, probes: int, similarity: float) -> DataFrame:
    """Distinct linked pairs (a < b, by name) of nodes found by looking in the ``probes`` nearest shards of each node, but for the ``first`` nearest."""
    block = F.pmod(F.shiftright(F.xxhash64("node"), 7), F.col("blocks"))
    routes = _routes(nodes, shared, probes, first)
    sizes = routes.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / SIDE_BY_SIDE).alias("blocks")).withColumn("lanes", F.ceil(F.col("blocks") / LANE))  # at most CENTRES a width
    # a vector moves once for each shard that it asks; its block is made where the shard's parts are
    asked = (routes.join(F.broadcast(sizes), "shard").select("shard", "node", block.alias("block"), F.pmod(block, F.col("lanes")).alias("lane"))
             .repartition("shard", "lane").groupBy("shard", "lane", "block").agg(F.collect_list("node").alias("queries")))
    there = found.join(F.broadcast(sizes.select("shard", "lanes")), "shard").withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lanes") - 1)))
    rows = asked.join(there, ["shard", "lane"]).select("members", "a", "b", "codes", "queries")

    def run(parts):
        for batch in parts:
            for i in range(batch.num_rows):
                members, codes, asked_ = (batch.column(k)[i].values for k in (0, 3, 4))
                x, q, names = matrix(members), matrix(asked_), _names(members.to_pylist())
                off = np.zeros(len(x))
                if len(codes):
                    near, error, called = decoded(codes.to_pylist(), x.shape[1])
                    x, off, names = np.concatenate([x, near]), np.r_[off, error], names + called
                table = neighbour_table(len(x), batch.column(1)[i].values.to_numpy(), batch.column(2)[i].values.to_numpy())
                a, b, s = range_search(x, table, q, similarity, off)
                sure = s >= similarity + off[b]
                for these in (True, False):
                    for pairs in _pairs(_names(asked_.to_pylist()), names, a[sure == these], b[sure == these]):
                        yield pairs.append_column("sure", pa.array([these] * len(pairs)))

    pairs = stored(rows.mapInArrow(run, "a binary, b binary, sure boolean").groupBy("a", "b").agg(F.max("sure").alias("sure")))
    return pairs.filter("sure").select("a", "b").union(_verified(pairs.filter("not sure"), nodes, similarity))


def _verified(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (a, b, by name) that are linked, by their vectors."""
    named = _named(nodes).select("name", "node")
    both = pairs.join(named.toDF("a", "x"), "a").join(named.toDF("b", "y"), "b").select("a", "b", "x", "y")

    def run(parts):
        for batch in parts:
            widths = np.array([len(v) for v in batch.column(2).to_pylist()])
            for w in np.unique(widths):
                some = batch.take(pa.array(np.flatnonzero(widths == w)))
                linked = np.einsum("ij,ij->i", matrix(some.column(2)), matrix(some.column(3))) >= similarity
                yield some.select(["a", "b"]).filter(pa.array(linked))

    return both.mapInArrow(run, "a binary, b binary")


def _compared(built: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Distinct linked pairs (a < b, by name): every node against all members of all parts, in blocks."""
    block = F.pmod(F.xxhash64("node"), F.lit(max(1, -(-nodes.count() // SIDE_BY_SIDE))))
    asked = nodes.select("node", F.length("node").alias("width")).groupBy("width", block.alias("block")).agg(F.collect_list("node").alias("queries"))
    rows = asked.join(built.select("members", F.length(F.col("members")[0]).alias("width")), "width").select("members", "queries")

    def run(parts):
        for batch in parts:
            for i in range(batch.num_rows):
                members, queries = batch.column(0)[i].values, batch.column(1)[i].values
                x, left, right = matrix(members), _names(queries.to_pylist()), _names(members.to_pylist())
                for start in range(0, len(left), 256):  # in a group of copies every pair is linked
                    a, b = np.nonzero(matrix(queries[start: start + 256]) @ x.T >= similarity)
                    yield from _pairs(left[start: start + 256], right, a, b)

    return rows.mapInArrow(run, "a binary, b binary").distinct()


def true_links(nodes: DataFrame, similarity: float, seed: int = 3) -> DataFrame:
    """All links (a < b, by name) of a hash sample of nodes that holds AUDIT_LINKS links, or of all nodes if they have no more."""
    n = nodes.count()
    place = F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(1 << 40))
    truth, done, step = None, 0.0, AUDIT_NODES
    while True:
        share = min(1.0, done + step / max(1, n))
        some = nodes.filter((place >= int(done * (1 << 40))) & (place < int(share * (1 << 40)))).select("node")
        # about ``step`` vectors, at most AUDIT_BLOCK
        more = _links_of([bytes(r[0]) for r in some.collect()], nodes, similarity)
        truth = stored(truth.union(more).distinct() if truth is not None else more)
        if share == 1.0 or truth.count() >= AUDIT_LINKS:
            return truth
        done, step = share, min(AUDIT_BLOCK, 4 * step)


def _links_of(some: list[bytes], nodes: DataFrame, similarity: float) -> DataFrame:
    """Distinct links (a < b, by name) of the given nodes, compared with all nodes."""
    queries = nodes.sparkSession.sparkContext.broadcast(some)

    def brute(parts):
        by_width: dict[int, list[bytes]] = {}
        for v in queries.value:
            by_width.setdefault(len(v), []).append(v)
        for batch in parts:
            column = batch.column(0)
            widths = np.array([len(x) for x in column.to_pylist()])
            for w, asked in by_width.items():
                rows = column.take(pa.array(np.flatnonzero(widths == w)))
                if len(rows):
                    a, b = np.nonzero(matrix(pa.array(asked, pa.binary())) @ matrix(rows).T >= similarity)
                    yield from _pairs(_names(asked), _names(rows.to_pylist()), a, b)

    return nodes.select("node").mapInArrow(brute, "a binary, b binary").distinct()


def audit(links: DataFrame, truth: DataFrame) -> float:
    """Recall: the share of the true links that ``links`` holds."""
    n = truth.count()
    return truth.join(links, ["a", "b"], "left_semi").count() / n if n else 1.0


def find_links(nodes: DataFrame, similarity: float, recall: float, probes: int = PROBES, seed: int = 4) -> DataFrame:
    """Distinct linked pairs (a < b, by name) among distinct unit vectors."""
    by_width: dict[int, list[bytes]] = {}
    for p in pivots(nodes, CENTRES, seed):
        by_width.setdefault(len(p), []).append(p)
    for r in nodes.select(F.length("node").alias("w")).distinct().collect():  # one row a width
        if r["w"] not in by_width:
            by_width[r["w"]] = pivots(nodes.filter(F.length("node") == r["w"]), CENTRES, seed)
    wanted = max(1, nodes.count() * COPIES // SHARD)
    centres, total = {}, 0
    for w, rows in sorted(by_width.items()):
        rows = rows[:wanted]
        centres[w] = (np.arange(total, total + len(rows), dtype=np.int32), matrix(pa.array(rows, pa.binary())))
        total += len(rows)
    shared = nodes.sparkSession.sparkContext.broadcast(centres)  # at most CENTRES vectors a width
    routes = _routes(nodes, shared, COPIES)
    sizes = routes.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / (2 * SHARD)).alias("parts"))
    dealt = routes.join(F.broadcast(sizes), "shard").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts"))).select("shard", "part", "node")
    built = stored(dealt.groupBy("shard", "part").applyInPandas(_built, "shard int, part long, members array<binary>, a array<long>, b array<long>"))
    united = stored(_united(built))
    truth = true_links(nodes, similarity)
    links, looked = None, 0
    while True:
        more = _links(united, nodes, shared, looked, probes, similarity)
        links = stored(links.union(more).distinct() if links is not None else more)
        if audit(links, truth) >= recall:
            return links
        if probes >= total:
            return stored(_compared(built, nodes, similarity))
        looked, probes = probes, min(total, 2 * probes)


def _linkable(vector: str):
    """Usable, and not all zero: what ``unit`` keeps."""
    return usable(vector) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def _components(links: DataFrame) -> DataFrame:
    """(name, component) of all linked nodes. Each node first goes to the smallest of itself and its neighbours, which leaves few links
    between different heads (none in a group whose members are all linked); their components are those of the nodes."""
    both = links.union(links.select(F.col("b"), F.col("a"))).toDF("name", "other")
    heads = stored(both.groupBy("name").agg(F.min("other").alias("least")).select("name", F.least("name", "least").alias("head")))
    between = (links.join(heads.toDF("a", "ha"), "a").join(heads.toDF("b", "hb"), "b").filter("ha <> hb").select(F.col("ha").alias("a"), F.col("hb").alias("b")).distinct())
    joined = components(between).toDF("head", "component")
    return heads.join(joined, "head", "left").select("name", F.coalesce("component", "head").alias("component"))


def vector_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", similarity: float = 0.95, recall: float = 0.99) -> DataFrame:
    """(key, n_links, component_id, kept) of every row."""
    ready = stored(packed(df, key, vector, unit))
    nodes = stored(ready.groupBy("node").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")))
    links = find_links(nodes.select("node"), similarity, recall)
    small = stored(_named(nodes).select("name", "least", "copies"))
    both = links.union(links.select(F.col("b"), F.col("a"))).toDF("name", "other")
    linked = (both.join(small.select(F.col("name").alias("other"), "copies"), "other").groupBy("name").agg(F.sum("copies").alias("others")))
    of_node = (small.join(linked, "name", "left").join(_components(links), "name", "left").withColumn("component", F.coalesce("component", "name")))
    least = of_node.groupBy("component").agg(F.min("least").alias("component_id"))
    known = of_node.join(least, "component").select("name", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    found = _named(ready).select("id", "name").join(known, "name").select(F.col("id").alias(key), "n_links", "component_id")
    rest = df.filter(~_linkable(vector)).select(F.col(key), F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"))
    return found.union(rest).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
