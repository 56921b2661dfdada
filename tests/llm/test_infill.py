"""Fill-in-the-middle: against plain Python, exact round trips, odd rows."""

import hashlib
import sys
from pathlib import Path

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from textlabel.llm import infill  # noqa: E402


def plainly(key, text, rate=90, spm=20, units=None):
    """One document, cut by Python strings."""
    text = text or ""
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    units = list(text) if units is None else units
    n = len(units)
    if not text or any(s in text for s in infill.SENTINELS) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="ab\n\0é日😀<P>", max_size=30), st.integers(0, 31), st.integers(0, 31)), max_size=8), st.integers(4, 40), st.sampled_from(infill.UNITS))
def test_pieces_of_any_window(rows, window, unit):
    cut = [list(t) if unit == "char" else [x + "\n" for x in t.split("\n")[:-1]] + ([t.split("\n")[-1]] if t.split("\n")[-1] else []) for t, _, _ in rows]
    places = [sorted((x % (len(u) + 1), y % (len(u) + 1))) for u, (_, x, y) in zip(cut, rows)]
    whole = pa.array(["zz", *[t for t, _, _ in rows]], pa.string()).slice(1)  # an array that begins inside its buffers
    got = infill.cut_pieces(whole, pa.array([a for a, _ in places], pa.int64()), pa.array([b for _, b in places], pa.int64()), unit, window)
    assert list(zip(*(x.to_pylist() for x in got))) == [("".join(u[:a]), "".join(u[a:b]), "".join(u[b:])) for u, (a, b) in zip(cut, places)]


TEXTS = [(i, t) for i, t in enumerate(["", None, "a", "日本語テキスト" * 50, "x<S>y", "tail <", "<P", "😀\0\r\n" * 9, "same", "same"] * 12)]
TEXTS += [(None, "no key"), (7, "an id again"), (7, "an id again"), (1000, "long é " * 400_000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("n", "form", "output", "_text", "_draws")})


def test_equals_plain_python_and_comes_back(docs):
    arranged = infill.fill_middle(docs)
    got = sorted(map(tuple, arranged.collect()), key=repr)
    assert got == sorted(((k, *plainly(k, t)) for k, t in TEXTS), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    back = infill.restore_text(arranged).collect()
    assert sorted(map(tuple, back), key=repr) == sorted(((k, t or "") for k, t in TEXTS), key=repr)


def test_lines_carried_columns_and_empty_table(docs):
    few = docs.filter("doc_id < 40")
    got = infill.fill_middle(few, unit="line", rate=100, spm=0, carry=("text", "form"), prefix="_fim_")
    assert got.columns == ["doc_id", "text", "form", "_fim_n", "_fim_form", "_fim_prefix_chars", "_fim_middle_chars", "_fim_output"]
    for r in got.collect():
        t = r["text"] or ""
        units = [x + "\n" for x in t.split("\n")[:-1]] + [x for x in t.split("\n")[-1:] if x]
        assert tuple(r)[3:] == plainly(r["doc_id"], t, 100, 0, units)
    assert infill.fill_middle(docs.limit(0)).collect() == []


@pytest.mark.parametrize("bad", [("", "b", "c"), ("<a>", "<a>", "<c>"), ("<", "<b>", "<c>"), ("<a<", "[b]", "{c}")])
def test_sentinels_that_could_be_mistaken_are_refused(docs, bad):
    with pytest.raises(ValueError):
        infill.fill_middle(docs, sentinels=bad)
    with pytest.raises(ValueError):
        infill.fill_middle(docs, unit="word")
