"""Label encoders and answer parsing against Python's own json semantics."""

import json
import re

import pytest
from pyspark.sql import functions as F

from textlabel.functions import jsonparse as J
from textlabel.functions import labels as L
from textlabel.operators import answers as A


def test_strict_and_lenient(spark):
    df = spark.createDataFrame([(1, "y"), (2, "n"), (3, None)], "id long, c string")
    assert [r[0] for r in df.orderBy("id").select(L.encode_strict("c")).collect()] == [1, 0, None]
    assert [r[0] for r in df.orderBy("id").select(L.encode_lenient("c")).collect()] == [1, 0, 0]
    bad = spark.createDataFrame([(1, "x")], "id long, c string")
    with pytest.raises(Exception):
        bad.select(L.encode_strict("c")).collect()
    assert bad.select(L.encode_strict("c", mode="null")).first()[0] is None


def test_frame_replace_hits_text_too(spark):
    df = spark.createDataFrame([(1, "y", "y", "n"), (2, "yes", "n", "n")], "id long, text string, a string, b string")
    got = {r["id"]: r for r in L.frame_replace(df, ["a", "b"]).collect()}
    assert got[1]["text"] == "1" and got[2]["text"] == "yes" and got[1]["a"] == 1 and got[2]["a"] == 0


def test_label_vector_scalar_for_one_label(spark):
    df = spark.createDataFrame([(1, 0)], "a int, b int")
    assert df.select(L.label_vector(["a", "b"])).first()[0] == [1.0, 0.0]
    assert df.select(L.label_vector(["a"])).first()[0] == 1.0


ANSWERS = [
    '{"quality": 1, "toxic": 0}',
    'Sure!\n{"quality": 1,\n "toxic": 1} ok',
    '{"quality": 1} and {"toxic": 0}',
    'Result: {"quality": 1, "toxic": 0',
    "no brace at all",
    "{}",
    '{"quality": "1", "toxic": true}',
    '{"quality": 0}',
    '{"quality": 1, "toxic": 0, "extra": 5}',
    '{"quality": 0, "quality": 1, "toxic": 0}',
    '{"quality": NaN, "toxic": 1}',
    '   \n {"quality": 0, "toxic": 1.0}  ',
    None,
]


def _py_parse(raw):
    if raw is None:
        return None
    m = re.search(r"\{[\s\S]*\}", raw.strip())
    if not m:
        return {}
    try:
        return json.loads(m.group(0))
    except json.JSONDecodeError:
        return {}


def _py_value(d, k):
    v = d.get(k) if d else None
    if isinstance(v, bool):
        return float(v)
    if isinstance(v, (int, float)) and v == v:
        return float(v)
    return None


def test_parse_answers_matches_python(spark):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ANSWERS)], "doc_id long, raw string")
    got = {r["doc_id"]: r for r in A.parse_answers(df, ["quality", "toxic"]).collect()}
    for i, raw in enumerate(ANSWERS):
        d = _py_parse(raw)
        assert got[i]["parse_ok"] == bool(d), raw
        if d:
            assert got[i]["quality"] == _py_value(d, "quality"), raw
            assert got[i]["toxic"] == _py_value(d, "toxic"), raw


def _py_split_cut(raw):
    if "{" not in raw:
        return None
    part = raw.split("{", 1)[1].rsplit("}", 1)[0]
    return "{" + part + "}"


def test_split_cut_repairs_unclosed(spark):
    cases = [a for a in ANSWERS if a is not None]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(cases)], "id long, raw string")
    got = [r[0] for r in df.orderBy("id").select(J.extract_braces_split(F.col("raw"))).collect()]
    assert got == [_py_split_cut(a) for a in cases]


def test_kept_and_missed_partition_rows(spark):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ANSWERS)], "doc_id long, raw string")
    parsed = A.parse_answers(df, ["quality", "toxic"])
    actual = spark.range(0, len(ANSWERS)).withColumnRenamed("id", "doc_id")
    kept = {r[0] for r in A.kept_rows(actual, parsed).collect()}
    missed = {r[0] for r in A.missed_rows(actual, parsed).collect()}
    assert kept | missed == set(range(len(ANSWERS))) and not kept & missed
    m = A.miss_counts(parsed).first()
    assert m["n_missed"] == len(missed) and m["n_total"] == len(ANSWERS)


def test_label_json_layout(spark):
    df = spark.createDataFrame([(1, 0)], "a int, b int")
    got = df.select(J.label_json([F.col("a"), F.col("b")], ["a", "b"], indent="  ")).first()[0]
    assert got == '  {\n      "a": 1,\n      "b": 0  \n  }'


JSON_TEXTS = ['{"quality": 1, "toxic": 0}', '{ }', '{}', '{"a": 1,}', '{"a": 1} and {"b": 2}', '{"a": 1, "a": 2}', '{"a": NaN}', '{"a": [1, 2]}', '{"a": {"b": 1}}',
              '{"a": "x{y"}', '{"a": "tab\\t"}', '{"a": "raw\ttab"}', '{"a": 01}', '{"a": -0}', '{"a": 1e400}', '{"a": 1e5}', '{"a": 12345678901234567890}',
              "{'a': 1}", '{"a": tru}', '{"a": true}', '{"a" : null , "b":"x"}', '{"a": 1}}', '{"a": 1} }', '{"\\u0061": 1, "a": 2}', '{"a": 1.}', '{"a": .5}', '{"a": +1}',
              '{"a":1\n,\r\n"b":2}', '{"a": 1\u00a0}', '{"a": "{\\"b\\": 1}"}', '{"a" 1}', '{"a": "unclosed}', '{"k: 1}', None]


def test_flat_json_decides_as_python_does(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(JSON_TEXTS)], "i long, t string")
    canonical, rest = J.flat_json("t")
    for r in df.select("t", canonical.alias("c"), rest.alias("r")).collect():
        if r["r"]:
            continue  # left to Python
        try:
            want = json.loads(r["t"]) if r["t"] is not None else None
        except ValueError:
            want = None
        assert (json.loads(r["c"]) if r["c"] is not None else None) == want, r
    left = [r["t"] for r in df.filter(rest).collect()]
    assert '{"quality": 1, "toxic": 0}' not in left and '{"a": 1} and {"b": 2}' not in left and '{"a": 01}' not in left
    long = spark.createDataFrame([("{" + ", ".join(f'"k{i}": {i}' for i in range(20_000)) + "}",)], "t string")
    assert long.select(J.flat_json("t")[1]).first()[0] is False


def test_answers_decided_by_expressions_meet_no_python(spark):
    from textlabel.operators import answers as A
    raw = [(i, t) for i, t in enumerate(["Sure! {\"a\": 1} ok", "no", "{\"a\": true, \"note\": \"x\"}", "{\"a\": 1", "{\"a\": [1]}", "{\"a\": 0, \"a\": 1}"])]
    out = A.parse_answers(spark.createDataFrame(raw, "doc_id long, raw string"), ["a"])
    assert {r["doc_id"]: (r["parse_ok"], r["a"]) for r in out.collect()} == {0: (True, 1.0), 1: (False, None), 2: (True, 1.0), 3: (False, None), 4: (True, None), 5: (True, 1.0)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    told, asked = plan.split("\n:- ", 1)[1].split("\n+- ", 1)
    assert "strict_json" not in told and "strict_json" in asked  # the branches of the union
