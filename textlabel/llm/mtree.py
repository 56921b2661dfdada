"""Exact top-k by inner product with an M-tree that is searched best-first, in bulk.

Vectors are made integers, floor(256 x). With one more coordinate, sqrt(M^2 - |x|^2) where M is the largest norm (0 for a query),
the largest inner product is the smallest Euclidean distance, so a metric tree answers the search.

Tree: at most ``PIVOTS`` routing objects, chosen by hash. Each vector goes to its nearest one and is stored with its distance to it
(the parent distance). The entries of a routing object are dealt to pages of about ``PAGE`` vectors, so copies, however many,
fill pages rather than one; a page keeps its entries by parent distance, and the smallest and largest of them: its covering radii.

Search, in two bulk steps that take nodes in the order of their bounds:
1. every query reads the page whose routing object is nearest and gets k scores to beat,
2. it then reads each page that the stored bounds cannot rule out. By the triangle inequality no entry is nearer to the query than
   |d(query, routing object) - d(entry, routing object)|; pages and then single entries whose bound is beyond the k-th distance are
   left out, before their distances are computed.
Distances only rule out (with a margin for rounding); scores are integers, exact in double precision up to 2^53, and ties go to
the smaller id.

``top_k``: (query_id, rank, vec_id, score). Queries are the usable rows whose id ``is_query``; a query is compared with every
usable row but those of its own id. Vectors that are null, empty or hold null or non-finite components take no part; vectors of another
width than the query's are not comparable and not its candidates. A repeated row is a candidate as often as it is there, and asks
once; an id with several vectors asks with each and gets the k best of all. Rows with a null id take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .vectors import matrix, packed, pivots

PIVOTS = 256
PAGE = 1024
#: queries that a page is searched for at once
BLOCK = 256


def _lifted(x: np.ndarray, most: float, query: bool) -> np.ndarray:
    last = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, most - (x * x).sum(axis=1)))
    return np.column_stack([x, last])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * (a @ b.T)))


def best_of(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int):
    """(row, column) of each row's k highest scores, ties to the smaller id, own ids left out."""
    scores = np.where(ids[None] == own[:, None], -np.inf, scores)
    kth = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] > k else np.full(len(scores), -np.inf)
    row, col = np.nonzero((scores >= kth[:, None]) & (scores > -np.inf))
    order = np.lexsort((ids[col], -scores[row, col], row))
    row, col = row[order], col[order]
    first = np.searchsorted(row, row)  # where each row begins
    keep = np.arange(len(row)) - first < k
    return row[keep], col[keep]


def build(vectors: DataFrame, seed: int):
    """The pages (width, pivot, page, ids, vectors, parents, near, far) and, by width, the routing objects and largest squared norm."""
    routing = {}
    for r in vectors.groupBy("width").agg(F.max("norm").alias("most")).collect():  # one row a width
        rows = pivots(vectors.filter(F.col("width") == r["width"]), PIVOTS, seed)
        x = np.array([np.frombuffer(p, dtype=np.float64) for p in rows])
        routing[r["width"]] = (_lifted(x, r["most"], False), r["most"])
    shared = vectors.sparkSession.sparkContext.broadcast(routing)  # at most PIVOTS vectors a width

    def assign(parts):
        for batch in parts:
            width = batch.column(1).to_numpy()
            nearest, parent = np.zeros(len(width), np.int32), np.zeros(len(width))
            for w in np.unique(width):
                at = np.flatnonzero(width == w)
                objects, most = shared.value[int(w)]
                d = _distances(_lifted(matrix(batch.column(2).take(pa.array(at))), most, False), objects)
                nearest[at], parent[at] = d.argmin(axis=1), d.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(nearest), pa.array(parent)], names=["id", "width", "node", "pivot", "parent"])

    routed = stored(vectors.select("id", "width", "node").mapInArrow(assign, "id long, width int, node binary, pivot int, parent double"))
    sizes = routed.groupBy("width", "pivot").agg(F.ceil(F.count(F.lit(1)) / PAGE).alias("pages"))  # at most PIVOTS a width
    dealt = routed.join(F.broadcast(sizes), ["width", "pivot"]).withColumn("page", F.pmod(F.xxhash64("id", "node"), F.col("pages")))
    entry = F.array_sort(F.collect_list(F.struct("parent", "id", "node")))
    pages = (dealt.groupBy("width", "pivot", "page").agg(entry.alias("e"))
             .select("width", "pivot", "page", F.col("e.id").alias("ids"), F.col("e.node").alias("nodes"), F.col("e.parent").alias("parents"),
                     F.element_at("e.parent", 1).alias("near"), F.element_at("e.parent", -1).alias("far")))
    return stored(pages), shared


def _search(visits: DataFrame, pages: DataFrame, most, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each visited page. visits: (width, pivot, page, block, queries of (id, node, distance to the
    routing object, score to beat))."""

    def run(parts):
        for batch in parts:
            for i in range(batch.num_rows):
                row = {n: batch.column(j).slice(i, 1) for j, n in enumerate(batch.schema.names)}
                asked = row["queries"].flatten()
                own, d, beat = (asked.field(n).to_numpy(zero_copy_only=False) for n in ("id", "d", "beat"))
                q = matrix(asked.field("node"))
                parents = row["parents"].flatten().to_numpy()
                largest = most.value[row["width"][0].as_py()][1]
                limit = np.sqrt(np.maximum(0.0, (q * q).sum(axis=1) + largest - 2 * beat))
                margin = 1e-7 * (1 + np.sqrt(largest) + limit)
                open_ = np.abs(d[:, None] - parents[None]) <= (limit + margin)[:, None]
                some = np.flatnonzero(open_.any(axis=0))
                if not len(some):
                    continue
                x = matrix(row["nodes"].flatten().take(pa.array(some)))
                ids = row["ids"].flatten().to_numpy()[some]
                scores = np.where(open_[:, some], q @ x.T, -np.inf)
                a, b = best_of(scores, ids, own, k)
                yield pa.RecordBatch.from_arrays([pa.array(own[a]), pa.array(ids[b]), pa.array(scores[a, b].astype(np.int64))], names=["query_id", "vec_id", "score"])

    joined = visits.join(pages.drop("near", "far"), ["width", "pivot", "page"])
    return joined.select("width", "parents", "ids", "nodes", "queries").mapInArrow(run, "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query, first among 16 parts of its candidates."""
    order = [F.desc("score"), "vec_id"]
    once = Window.partitionBy("query_id", "_part").orderBy(*order)
    found = found.withColumn("_part", F.pmod(F.xxhash64("vec_id"), F.lit(16))).withColumn("rank", F.row_number().over(once)).filter(F.col("rank") <= k)
    return (found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
            .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def top_k(df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5, seed: int = 8) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest integer inner products of every query."""
    ready = packed(df.filter(F.col(key).isNotNull()), key, vector, lambda x: np.floor(256 * x))
    vectors = stored(ready.mapInArrow(_with_norm, "id long, node binary, width int, norm double"))
    pages, routing = build(vectors, seed)
    directory = stored(pages.select("width", "pivot", "page", "near", "far"))
    asked = stored(vectors.join(df.filter(is_query).select(F.col(key).cast("long").alias("id")).distinct(), "id", "left_semi")
                   .select("id", F.xxhash64("node").alias("which"), "node", "width", "norm").distinct())

    def distances(parts):
        for batch in parts:
            width = batch.column(2).to_numpy()
            out: list = [None] * len(width)
            for w in np.unique(width):
                at = np.flatnonzero(width == w)
                objects, most = routing.value[int(w)]
                for r, d in zip(at, _distances(_lifted(matrix(batch.column(3).take(pa.array(at))), most, True), objects)):
                    out[r] = d
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], batch.column(4), pa.array(out, pa.list_(pa.float64()))], names=["id", "which", "width", "norm", "ds"])

    measured = stored(asked.select("id", "which", "width", "node", "norm")
                      .mapInArrow(distances, "id long, which long, width int, norm double, ds array<double>"))
    block = F.pmod(F.xxhash64("id", "which"), F.lit(max(1, measured.count() // BLOCK)))

    def visits(rows: DataFrame) -> DataFrame:
        # queries meet a page in blocks of about BLOCK
        return (rows.select("width", "pivot", "page", "id", "which", "d", "beat").join(asked.select("id", "which", "node"), ["id", "which"])
                .groupBy("width", "pivot", "page", block.alias("block")).agg(F.collect_list(F.struct("id", "node", "d", "beat")).alias("queries")))

    # step 1: a page of the nearest routing object
    entry = directory.groupBy("width", "pivot").agg(F.min("page").alias("page"))  # at most PIVOTS rows a width
    first = (measured.withColumn("d", F.array_min("ds")).withColumn("pivot", (F.array_position("ds", F.col("d")) - 1).cast("int"))
             .join(F.broadcast(entry), ["width", "pivot"]).withColumn("beat", F.lit(float("-inf"))))
    opening = _best(_search(visits(first), pages, routing, k), k)
    to_beat = (opening.groupBy("query_id").agg(F.max("rank").alias("n"), F.min("score").alias("low"))
               .select(F.col("query_id").alias("id"), F.when(F.col("n") == k, F.col("low").cast("double")).otherwise(float("-inf")).alias("beat")))
    # step 2: every page within the distance of the k-th score
    largest = F.create_map(*[F.lit(x) for w, (_, most) in routing.value.items() for x in (w, most)]) if routing.value else F.lit(None).cast("map<int,double>")
    limited = (measured.join(to_beat, "id", "left").withColumn("beat", F.coalesce("beat", F.lit(float("-inf"))))
               .withColumn("largest", largest[F.col("width")])
               .withColumn("limit", F.sqrt(F.greatest(F.lit(0.0), F.col("norm") + F.col("largest") - 2 * F.col("beat"))))
               .withColumn("limit", F.col("limit") + 1e-7 * (1 + F.sqrt("largest") + F.col("limit"))))
    span = directory.groupBy("width", "pivot").agg(F.min("near").alias("near"), F.max("far").alias("far"))
    in_reach = (F.col("d") - F.col("far") <= F.col("limit")) & (F.col("near") - F.col("d") <= F.col("limit"))
    objects = (limited.select("id", "which", "width", "beat", "limit", F.posexplode("ds").alias("pivot", "d"))
               .join(F.broadcast(span), ["width", "pivot"]).filter(in_reach).drop("near", "far"))
    leaves = objects.join(directory, ["width", "pivot"]).filter(in_reach)
    return _best(_search(visits(leaves), pages, routing, k), k)


def _with_norm(parts):
    for batch in parts:
        nodes = batch.column(1).to_pylist()
        x = [np.frombuffer(n, dtype=np.float64) for n in nodes]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array([len(v) for v in x], pa.int32()),
                                          pa.array([float(v @ v) for v in x], pa.float64())], names=["id", "node", "width", "norm"])
