"""The queries that SQL does not express, against plain Python on small tables."""

import collections
import hashlib
import random
import re
import sys
import zlib
from bisect import bisect_left, insort
from pathlib import Path

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from textlabel.llm import components, langid, neardup, packing, pieces, pii, token_counts, vector_graph  # noqa: E402
from textlabel.llm.oracle import ORACLE_SQL  # noqa: E402
from textlabel.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.piece_path())


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(ORACLE_SQL[name]).to_arrow_table().to_pylist()
    got = [r.asDict() for r in QUERIES[name](spark, SF).collect()]
    assert sorted(map(repr, (sorted(r.items()) for r in got))) == sorted(map(repr, (sorted(r.items()) for r in want)))


def test_op1(spark, texts, library):
    for r in QUERIES["op1_sentencepiece"](spark, SF).collect():
        ids = library.encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_crc32"], r["round_trip"]) == (len(ids), zlib.crc32(np.array(ids, "<i4").tobytes()), True)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab the\n\u2581é1,.\0日 ", max_size=200) | st.text(max_size=60))
def test_pieces_equal_the_library(text):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.piece_path())
    text = text.encode("utf-8", "ignore").decode()
    model = pieces.load_model(pieces.piece_path())
    ids = np.frombuffer(model.encode([text])[0], "<i4").tolist()
    assert ids == sp.encode(text) and model.decode(ids) == sp.decode(ids) == text.replace("\u2581", " ")
    words = [w for w in pieces.segments(text) if w]
    assert sum(token_counts._lengths(pieces.piece_path(), words)) == len(ids)


def test_long_segments_use_the_heap(library):
    model = pieces.load_model(pieces.piece_path())
    for text in ("ab" * 500, "日本語テキスト" * 60, " " * 70 + "x", "a" * 49):
        assert np.frombuffer(model.encode([text])[0], "<i4").tolist() == library.encode(text)


def test_op3_recall_and_links(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(400, 16))
    near = np.concatenate([base[:60] + 0.05 * rng.normal(size=(60, 16)), np.repeat(base[:3], 40, axis=0), base[5] + 0.08 * rng.normal(size=(120, 16))])
    x = np.concatenate([base, near])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (u @ u.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    comp = np.arange(len(x))
    for _ in range(len(x)):
        new = np.array([min(comp[i], comp[linked[i]].min(initial=len(x))) for i in range(len(x))])
        if (new == comp).all():
            break
        comp = new
    got = {r["vec_id"]: r for r in vector_graph.vector_duplicates(df).collect()}
    assert sum(r["n_links"] for r in got.values()) >= 0.98 * linked.sum() and all(got[i]["n_links"] <= linked[i].sum() for i in got)
    assert np.mean([got[i]["component_id"] == comp[i] for i in got]) >= 0.98


def groups_of_copies(sizes, width=32):
    """Groups of distinct near copies and no other vectors."""
    rng = np.random.default_rng(5)
    x = np.concatenate([c + 0.02 * rng.normal(size=(n, width)) for n, c in zip(sizes, rng.normal(size=(len(sizes), width)))])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("sizes", [[100, 100], [200] * 10, [2000, 100, 100, 500]])
def test_op3_groups_without_bridges(sizes):
    x = groups_of_copies(sizes)
    a, b, _ = vector_graph.range_search(x, vector_graph.neighbour_table(len(x), *vector_graph.robust_pruned(x)), x, 0.95)
    found, true = np.unique(a * len(x) + b), np.flatnonzero(x @ x.T >= 0.95)
    assert len(found) == len(true) and (found == true).all()


def as_nodes(spark, x):
    return spark.createDataFrame([(bytearray(v.tobytes()),) for v in x], "node binary")


def test_op3_audit_of_rare_links(spark):
    x = np.random.default_rng(6).normal(size=(3000, 32))
    x[-3:] = x[:3] + 1e-3
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert vector_graph.true_links(as_nodes(spark, x), 0.95).count() == 3


def test_op3_lost_links_are_compared_exactly(spark, monkeypatch):
    x = groups_of_copies([30] * 5)
    nodes = as_nodes(spark, x)
    monkeypatch.setattr(vector_graph, "_links", lambda *_: spark.createDataFrame([], "a binary, b binary"))
    assert vector_graph.find_links(nodes, 0.95, 0.99).count() == 5 * 30 * 29 / 2


def test_op3_united_lists(spark):
    """u and w meet in no part; w is found from u by the list that v has in the other part."""
    u, v, w = (np.array([np.cos(t), np.sin(t)]) for t in (0.0, 0.1, 0.2))
    rows = [(0, 0, [u, v]), (1, 0, [v, w])]
    built = spark.createDataFrame([(s, p, [bytearray(x.tobytes()) for x in m], [0], [1]) for s, p, m in rows],
                                  "shard int, part long, members array<binary>, a array<long>, b array<long>")
    part = vector_graph._united(built).filter("shard = 0").first()
    x = np.array([np.frombuffer(m) for m in part["members"]])
    assert x.tolist() == [u.tolist(), v.tolist(), w.tolist()]
    _, found, _ = vector_graph.range_search(x, vector_graph.neighbour_table(3, np.array(part["a"]), np.array(part["b"])), u[None], 0.95)
    assert sorted(found.tolist()) == [0, 1, 2]


def near_the_limit(n=300, width=64):
    """Pairs of vectors with cosines a little below and above 0.95."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(n, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    aside = rng.normal(size=(n, width))
    aside -= (aside * x).sum(axis=1, keepdims=True) * x
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cos = 0.95 + rng.uniform(-0.004, 0.004, size=(n, 1))
    y = cos * x + np.sqrt(1 - cos * cos) * aside
    return np.concatenate([x, y / np.linalg.norm(y, axis=1, keepdims=True)])


def test_op3_codes_bound_every_dot_product():
    x = near_the_limit()
    near, off, names = vector_graph.decoded(vector_graph.coded(x, vector_graph._names([v.tobytes() for v in x])), 64)
    assert (np.abs(x @ near.T - x @ x.T) <= off).all() and off.max() < 0.02
    assert names == vector_graph._names([v.tobytes() for v in x])


def test_op3_parts_hold_a_vector_once(spark):
    """A neighbour that is in another part comes as a code, not as a vector."""
    x = near_the_limit(3, 64)[[0, 3, 1, 4]]
    rows = [(0, 0, [0, 1, 2]), (1, 0, [1, 2, 3])]
    built = spark.createDataFrame([(s, p, [bytearray(x[i].tobytes()) for i in m], [0, 1], [1, 2]) for s, p, m in rows],
                                  "shard int, part long, members array<binary>, a array<long>, b array<long>")
    for part, own, other in zip(vector_graph._united(built).orderBy("shard").collect(), ([0, 1, 2], [1, 2, 3]), (3, 0)):
        assert [bytes(m) for m in part["members"]] == [x[i].tobytes() for i in own]
        assert [len(c) for c in part["codes"]] == [20 + 64] and bytes(part["codes"][0][:12]) == vector_graph._names([x[other].tobytes()])[0]
        links = {tuple(sorted([*own, other][k] for k in link)) for link in zip(part["a"], part["b"])}
        assert links == {(0, 1), (1, 2), (2, 3)}


def test_op3_small_parts_lose_and_add_nothing(spark, monkeypatch):
    """Many parts, each node in one, so that half of what is found is found by codes; every pair is near the limit."""
    for name, value in (("SHARD", 30), ("SIDE_BY_SIDE", 16), ("LANE", 2)):
        monkeypatch.setattr(vector_graph, name, value)
    fetched = []
    verified = vector_graph._verified
    monkeypatch.setattr(vector_graph, "_verified", lambda pairs, *more: fetched.append(pairs.count()) or verified(pairs, *more))
    x = near_the_limit()
    names = vector_graph._names([v.tobytes() for v in x])
    want = {tuple(sorted((names[i], names[j]))) for i, j in zip(*np.nonzero(x @ x.T >= 0.95)) if i < j}
    got = [(bytes(r["a"]), bytes(r["b"])) for r in vector_graph.find_links(as_nodes(spark, x), 0.95, 0.99, probes=2).collect()]
    assert len(got) == len(set(got)) and set(got) <= want and len(got) >= 0.99 * len(want) and sum(fetched) > 0


def test_op3_goes_on_with_the_shards_not_asked_yet(spark, monkeypatch):
    monkeypatch.setattr(vector_graph, "SHARD", 30)
    asked, shares, links = [], iter([0.0, 0.0, 1.0]), vector_graph._links
    monkeypatch.setattr(vector_graph, "_links", lambda found, nodes, shared, first, probes, s: asked.append((first, probes)) or links(found, nodes, shared, first, probes, s))
    monkeypatch.setattr(vector_graph, "audit", lambda *_: next(shares))
    x = near_the_limit()
    names = vector_graph._names([v.tobytes() for v in x])
    want = {tuple(sorted((names[i], names[j]))) for i, j in zip(*np.nonzero(x @ x.T >= 0.95)) if i < j}
    got = [(bytes(r["a"]), bytes(r["b"])) for r in vector_graph.find_links(as_nodes(spark, x), 0.95, 0.99, probes=3).collect()]
    assert asked == [(0, 3), (3, 6), (6, 12)] and len(got) == len(set(got)) and set(got) <= want and len(got) >= 0.99 * len(want)


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
            fits = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")), "card": 14 <= len(digits) <= 19 and luhn,
                    "phone": 10 <= len(digits) <= 15}[kind]
            if fits:
                out.append((m.start(), n, m.end(), kind))
    return sorted(out)


def test_op4(spark, texts):
    for r in QUERIES["op4_pii"](spark, SF).collect():
        spans = base_spans(texts[r["doc_id"]])
        joined = [f"{k}:{a}:{b}" for a, _, b, k in spans]
        assert r["base_sha256"] == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in BASE] == [sum(s[3] == k for s in spans) for k in BASE] and set(joined) <= set(r["spans"].split(",")) | {""}


def test_pii_on_random_strings(spark):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice(["a@b.c", "x_y@", "1.2.3.4", "300.1", ".", "+1", "4111111111111111", "4111 1111-1111 1111", " ", "-", "7", "(415) ", "é", "@"])
                                    for _ in range(rng.randint(1, 14)))) for i in range(1500)] + [(-1, "7" * 30000), (-2, "1." * 5000), (-3, "a" * 30000 + "@")]
    got = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", pii.joined("base").alias("b")).collect()
    found = {r["doc_id"]: r["b"] for r in got}
    assert [(t, found[i]) for i, t in rows[:1500]] == [(t, ",".join(f"{k}:{a}:{b}" for a, _, b, k in base_spans(t))) for _, t in rows[:1500]]
    assert (found[-1], found[-3]) == ("", "") and found[-2].count("ip") == 1250


def test_redaction(spark):
    df = spark.createDataFrame([(1, "é a.b@c.de, 1.2.3.4!", 7), (2, None, 8), (3, "none", 9)], "doc_id long, text string, spans long")
    rows = pii.redact(df).collect()
    assert [tuple(r) for r in rows] == [(1, "é <EMAIL>, <IP>!", 7), (2, None, 8), (3, "none", 9)]


def test_op5_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = [r for r in QUERIES["op5_language"](spark, sf).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97 and all(0 <= r["score"] <= 1 for r in held)


def test_no_letter_is_und():
    assert all(langid.words_of(t) == "" for t in ("", "12 ++", "½ ² 3", "_")) and langid.words_of("é")


def test_op6(spark, texts, library):
    for r in QUERIES["op6_token_counts"](spark, SF).collect():
        n = len(library.encode(texts[r["doc_id"]]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 4096)


def best_fit_decreasing(counts, limit):
    gaps, opened = [], 0
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            at = bisect_left(gaps, length)
            opened += at == len(gaps)
            gap = gaps.pop(at) if at < len(gaps) else limit
            if gap > length:
                insort(gaps, gap - length)
    return opened, gaps


def test_best_fit_places_all():
    for seed in range(200):
        rng = random.Random(seed)
        counts = collections.Counter(rng.randint(1, 19) for _ in range(rng.randint(1, 300)))
        placed, opened = packing.best_fit(dict(counts), 20)
        fewest, left = best_fit_decreasing(counts, 20)
        bins, seen = collections.defaultdict(list), collections.Counter()
        for length, _, docs, first, offset in placed:
            seen[length] += docs
            for i in range(docs):
                bins[first + i].append((offset, length))
        assert seen == counts and len(bins) == opened == fewest
        assert sorted(20 - sum(n for _, n in items) for items in bins.values() if sum(n for _, n in items) < 20) == left
        for items in bins.values():
            at = 0
            for offset, length in sorted(items):
                assert offset == at
                at += length
            assert at <= 20


def test_op7(spark, texts):
    encoder = packing.word_encoder(packing.word_path())
    rows = QUERIES["op7_packing"](spark, SF).collect()
    total = 0
    for i, text in texts.items():
        ids = encoder.tokenizer.encode(text, add_special_tokens=False).ids + [1]
        cuts = [ids[k: k + 4096] for k in range(0, len(ids), 4096)]
        total += len(ids)
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == i) == [
            (k, 4096 * k, len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for k, c in enumerate(cuts)]
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in bins.values():
        items.sort()
        assert [o for o, _ in items] == np.cumsum([0, *[n for _, n in items[:-1]]]).tolist() and sum(n for _, n in items) <= 4096
    assert len(bins) <= -(-total // 4096) + 1


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abC'stÉéİßΣ1,.\n \t<|x\u0301", max_size=60) | st.text(max_size=30))
def test_word_ids_equal_the_library(text):
    encoder = packing.word_encoder(packing.word_path())
    text = text.encode("utf-8", "ignore").decode()
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_op9_held_out(spark):
    sf = "/root/testdata/sf0.1"
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(r["score"], r["predicted"], label[r["doc_id"]]) for r in QUERIES["op9_quality"](spark, sf).collect() if r["held_out"] and r["doc_id"] in label]
    good, bad = ([s for s, _, y in held if y == k] for k in (1, 0))
    assert np.mean([s > t for s in good for t in bad]) > 0.97 and np.mean([p for _, p, y in held if y == 1]) > 0.98
    assert all(p == (s >= 0.3) for s, p, _ in held)


def test_op10_planted(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    bases = [[word() for _ in range(120)] for _ in range(40)]
    rows, truth = [], []
    for b, base in enumerate(bases):
        for c in range(1 + (b % 4) + 60 * (b == 0)):
            w = list(base)
            for _ in range(c % 3):
                w[rng.randrange(len(w))] = word()
            rows.append((len(rows), (" " if c % 2 else ", ").join(w).upper() if c == 1 else " ".join(w)))
            truth.append(b)
    got = {r["doc_id"]: r for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    first = {}
    for i, b in enumerate(truth):
        assert got[i]["class_id"] == first.setdefault(b, i) and got[i]["kept"] == (first[b] == i)


def test_op10_equals_all_pairs_of_every_bucket(spark):
    """Copies whose similarities lie on both sides of the limit: the classes are those of all pairs that share a band."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(90)]
    texts = []
    for i in range(260):
        w = list(base)
        for _ in range(i % 9):
            w[rng.randrange(90) // 3 * 3] = rng.choice("xyz") * 4
        texts.append(" ".join(w))
    doc, h, tf, digests = neardup.shingles_of(texts)
    counts = np.bincount((h >> np.uint64(neardup._HASH_BITS - neardup.COUNTER_BITS)).astype(np.int64), minlength=neardup.COUNTERS)
    weight = neardup.weights_of(h, tf, neardup.idf_table(counts, len(texts)))
    samples = neardup.samples_of(doc, h, weight, len(texts))
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    sets = [(h[a:b], weight[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    least = list(range(len(texts)))
    links = []
    for i in range(len(texts)):
        for j in range(i):
            same = samples[i] == samples[j]
            meet = digests[i] == digests[j] or (same.reshape(neardup.BANDS, -1).all(axis=1).any() and same.sum() >= neardup.AGREE)
            if meet and neardup.weighted_jaccard(sets[i], sets[j]) >= 0.8:
                links.append((i, j))
    while True:
        before = list(least)
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
        if least == before:
            break
    got = neardup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == dict(enumerate(least))
    assert 1 < len(set(least)) < len(texts)


def shuffled_words(rng, n=120):
    return ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n)]


def test_op10_null_keys(spark):
    """Texts that only rows without a key hold are compared; one row of each class is kept."""
    rng = random.Random(13)
    one, two, three = (shuffled_words(rng) for _ in range(3))
    changed = lambda w: " ".join(w[:60] + ["other"] + w[61:])
    rows = [(None, " ".join(one)), (None, changed(one)), (None, " ".join(one)), (None, " ".join(two)), (7, changed(two)), (3, " ".join(three)), (3, " ".join(three)),
            (None, " ".join(three)), (None, None), (None, "...")]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    by_class = collections.Counter((r["class_id"], r["kept"]) for r in got.collect())
    assert by_class == {(None, True): 3, (None, False): 2, (7, True): 1, (7, False): 1, (3, True): 1, (3, False): 2}


def test_op10_exact_copies_alone(spark):
    rng = random.Random(14)
    text = " ".join(shuffled_words(rng))
    got = neardup.near_duplicates(spark.createDataFrame([(1, text), (2, text), (3, " ".join(shuffled_words(rng)))], "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == [(1, 1, True), (2, 1, False), (3, 3, True)]


def test_neardup_stage_with_repeated_and_null_ids(spark):
    """Of the rows that repeat or nearly repeat one is left; every other text stays, whatever its id."""
    rng = random.Random(15)
    lone = [" ".join(shuffled_words(rng)) for _ in range(30)]
    base = shuffled_words(rng)
    near = [" ".join(base[:i] + ["other"] + base[i + 1:]) for i in (30, 120, 90)]
    rows = ([(1, t) for t in lone[:10]] + [(None, t) for t in lone[10:20]] + list(enumerate(lone[20:], 100)) + [(1, near[0]), (0, near[1]), (None, near[2]), (1, near[0])]
            + [(None, lone[12]), (None, lone[12]), (105, lone[25])])
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, place long")
    one, many = (sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"], r["place"]) for r in corpus_pipeline.neardup_stage(spark, d, "").collect()) for d in (docs.coalesce(1), docs.repartition(5)))
    want = [(1, t) for t in lone[:10]] + [(-1, t) for t in lone[10:20]] + list(enumerate(lone[20:], 100)) + [(0, near[1])]
    assert [r[:2] for r in one] == sorted(want) and one == many


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    root = {n: n for e in links for n in e}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got.get(n, n) == c for n, c in root.items())


def test_results_do_not_change_with_the_layout(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one, many = (sorted(map(tuple, neardup.near_duplicates(d).collect())) for d in (docs.coalesce(1), docs.repartition(7, F.col("source"))))
    assert one == many
