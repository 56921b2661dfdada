"""Every operator and stage on null, empty, long and repeated rows, empty tables and clashing columns."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from textlabel.llm import langid, mtree, neardup, packing, pieces, pii, quality, token_counts, url_filter, vector_graph  # noqa: E402

LONG = "the quick brown fox jumps over a lazy dog and runs " * 3000
TEXTS = [(1, "the quick brown fox jumps over the lazy dog in the park"), (2, None), (3, ""), (4, LONG), (5, "   \n\t "), (5, "   \n\t "),
         (6, "12345 +++ 678"), (None, "le renard brun saute par dessus le chien paresseux"), (7, "x" * 20000), (8, "日本語 a\0b é")]
CLASHES = ("ids", "n_tokens", "score", "predicted", "lang_pred", "rejected", "node", "samples", "piece", "length", "offset", "spans", "base", "class_id", "kept")


@pytest.fixture(scope="module")
def docs(spark):
    out = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text")})
    return out.withColumns({c: F.lit(1) for c in CLASHES})


TEXT_OPERATORS = {
    "pieces": lambda d: pieces.encode_pieces(d),
    "round trip": lambda d: pieces.decode_pieces(pieces.encode_pieces(d)),
    "token counts": lambda d: token_counts.token_counts(d),
    "packing": lambda d: packing.pack(packing.token_pieces(d)),
    "pii": lambda d: pii.find_pii(d),
    "language": lambda d: langid.predict_language(d, langid.learn_languages(d)),
    "quality": lambda d: quality.score_quality(d, quality.learn_quality(d, d.select("doc_id", F.lit(1).alias("quality")))),
    "near duplicates": lambda d: neardup.near_duplicates(d),
}


@pytest.mark.parametrize("name", TEXT_OPERATORS)
def test_odd_rows(docs, name):
    rows = TEXT_OPERATORS[name](docs).collect()
    assert len(rows) >= len(TEXTS) and {r["doc_id"] for r in rows} == {t[0] for t in TEXTS}
    assert sum(r["doc_id"] == 5 for r in rows) == 2


@pytest.mark.parametrize("name", TEXT_OPERATORS)
def test_empty_table(docs, name):
    assert TEXT_OPERATORS[name](docs.limit(0)).collect() == []


def test_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [None, 1.0]),
            (9, [0.0, 1.0]), (9, [0.0, 1.0]), (10, [1.0]), (None, [1.0, 0.001])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"n_links": F.lit(9), "node": F.lit(1), "score": F.lit(0)})
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in vector_graph.vector_duplicates(df).collect())
    assert got == sorted([(1, 2, 1, True), (2, 2, 1, False), (0, 2, 1, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True),
                          (7, 0, 7, True), (8, 0, 8, True), (9, 1, 9, True), (9, 1, 9, True), (10, 0, 10, True)])
    top = mtree.top_k(df, F.col("vec_id").isin(1, 3, 10)).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(top, key=lambda r: (r["query_id"], r["rank"]))] == [(1, 2, 131072), (2, 5, 0), (3, 9, 0), (4, 9, 0)]
    empty = df.limit(0)
    assert vector_graph.vector_duplicates(empty).collect() == [] and mtree.top_k(empty, F.col("vec_id") > 0).collect() == []


def test_urls(spark):
    urls = [(1, "http://M.Example.org/en/17?x"), (2, None), (3, "nourl"), (4, "x://a.com/fr/1#t"), (5, "x://notexample.org/es/"), (6, "x://a.org"), (6, "x://a.org"),
            (None, "x://com/de/"), (8, "x://" + "a." * 3000 + "com/fr/" + "y" * 5000), (9, "x:///org/")]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumns({"host": F.lit(1), "path": F.lit(1), "rule": F.lit(1), "verdict": F.lit(1)})
    rules = url_filter.rule_table(spark, url_filter.RULES)
    got = sorted((r["page_id"] or 0, r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, rules).collect())
    assert got == [(0, "com/de/", "block"), (1, "example.org/en/1", "block"), (2, None, "allow"), (3, None, "allow"), (4, "com/fr/", "allow"),
                   (5, "org/", "allow"), (6, None, "allow"), (6, None, "allow"), (8, "com/fr/", "allow"), (9, None, "allow")]
    assert url_filter.judge_urls(pages.limit(0), rules).collect() == []
    assert {r["verdict"] for r in url_filter.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


@pytest.mark.parametrize("rows", [None, 0])
def test_stages(spark, docs, tmp_path, rows):
    spark.createDataFrame([(1, 1, 0), (4, 1, 0), (6, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = docs if rows is None else docs.limit(0)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        out = spark.read.parquet(f"{tmp_path}/{i}")
        assert name == "packing" or out.columns == docs.columns
        docs = out if out.count() or rows == 0 else docs
    assert (docs.count() == 0) == (rows == 0)


@pytest.mark.parametrize("key", [7, None])
def test_fits_gather_no_more_than_stated_whatever_the_keys(spark, monkeypatch, key):
    """One id, or none, on two thirds of the rows."""
    rows = [(key if i % 3 else i, f"some words number {i} of a text in one language", "en" if i % 2 else "de", i % 2) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    seen = []
    monkeypatch.setattr(langid, "fit", lambda examples, *a, **k: seen.append(len(examples)))
    langid.learn_languages(df, per_language=100)
    monkeypatch.setattr(quality, "fit", lambda examples, share: seen.append(len(examples)))
    quality.learn_quality(df.select("doc_id", "text"), df.select("doc_id", "quality"), per_label=100)
    assert 150 <= seen[0] <= 200 and 100 <= seen[1] <= 300
