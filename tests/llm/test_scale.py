"""What the operators of textlabel.llm make or keep along the way, on tables built here."""

import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import types as T

from textlabel.llm import common, neardup, packing


def test_frequent_words_outlive_a_generation(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 40)
    encoder = packing.WordEncoder(packing.word_path())
    asked = []
    model_ids = encoder.token
    monkeypatch.setattr(encoder, "token", lambda pre: asked.append(pre) or model_ids(pre))
    name = "".join
    for i in range(60):
        rare = [name(chr(97 + (i * 7 + j * k) % 26) for k in (1, 3, 5, 9, 11)) + name(chr(97 + int(c)) for c in str(i * 10 + j)) for j in range(10)]
        encoder.encode(" ".join(["often", "Often,", *rare]))
    assert len(encoder) + len(encoder.older) < 2 * (40 + 24)
    assert asked.count("often") == 1 and asked.count(",") == 1


def test_words_with_marks_have_the_library_s_ids():
    encoder = packing.WordEncoder(packing.word_path())
    library = tokenizers.Tokenizer.from_file(packing.word_path())
    for text in ["Word, word. WORD?! don't 's 'tis <|endoftext|> a<|startoftext|>, <|x e-mail x9. (so) \x1cab\x7f, naïve, Ñandú! ǅ İ ½ a½, é", "", " , ", "it's", "ab'S."]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == b"".join(i.to_bytes(4, "little") for i in ids)


def test_a_word_of_a_slice_is_looked_up_once():
    """Repeated words, marks after them and capitals cost no further call of the model, in ASCII or not."""
    encoder = packing.WordEncoder(packing.word_path())
    library = tokenizers.Tokenizer.from_file(packing.word_path())
    asked, looked = [], []
    model_ids, found = encoder.token, encoder.found
    encoder.token = lambda pre: asked.append(pre) or model_ids(pre)
    encoder.found = lambda word: looked.append(word) or found(word)
    texts = ["Zürich zürich, zürich!\nblorft Blorft, BLORFT.", None, "", "zürich. blorft blorft,", " zürich  \n", "<|endoftext|>, don't 'llx'm Ž9 a×b"] * 3
    ids, ends = encoder.encode_all(pa.array(texts))
    assert ends.tolist()[0] == 0 and len(ends) == len(texts) + 1 and ends[-1] == len(ids)
    for text, first, last in zip(texts, ends, ends[1:]):
        assert ids[first:last].tolist() == library.encode(text or "", add_special_tokens=False).ids
    assert asked.count("zürich") == asked.count("blorft") == 1 and len(looked) == len(set(looked))
    assert encoder.encode_all(pa.array([], pa.string()))[1].tolist() == [0]


def test_bounds_of_pairs_are_never_too_small():
    rng = np.random.default_rng(1)
    x = np.r_[0.0, rng.random(2000) * 10.0 ** rng.integers(-9, 5, 2000), 70000.0]
    half = neardup._half_above(x)
    assert (half >= x).all() and (half[1:-1].astype(float) <= x[1:-1] * 1.001 + 1e-7).all()


def test_blocks_are_crossed_whole(monkeypatch):
    rng = np.random.default_rng(2)
    for pairs in (1, 7, 64, 10_000):
        monkeypatch.setattr(neardup, "PAIRS", pairs)
        n, m = rng.integers(1, 9, 30), rng.integers(1, 40, 30)
        left, right = np.r_[0, np.cumsum(n)], np.r_[0, np.cumsum(m)]
        got = [tuple(map(int, t)) for row, a, b in neardup._crossed(left, right) for t in zip(row, a, b)]
        assert len(got) == len(set(got)) and set(got) == {(r, a, b) for r in range(30) for a in range(left[r], left[r + 1]) for b in range(right[r], right[r + 1])}
    assert list(neardup._crossed(np.zeros(1, int), np.zeros(1, int))) == []


def test_texts_beside_a_group_are_not_compared_one_by_one(spark, monkeypatch):
    """Texts that share a bucket and their changes with others, but are similar to few: their pairs with the group do not leave the blocks."""
    rng = np.random.default_rng(3)
    base = [f"w{rng.integers(10 ** 6)}" for _ in range(160)]
    changes = [(12 * i + 3, f"c{i}") for i in range(13)]
    texts = [" ".join(w if k != 5 + 2 * i else f"n{i}" for k, w in enumerate(base)) for i in range(60)]
    for _ in range(60):
        change = dict(changes[i] for i in rng.choice(13, 6, replace=False))
        texts.append(" ".join(change.get(k, w) for k, w in enumerate(base)))
    compared = []
    verified = neardup._verified
    monkeypatch.setattr(neardup, "_verified", lambda pairs, *more: compared.append(pairs.count()) or verified(pairs, *more))
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert {got[i] for i in range(60)} == {0} and len(got) == 120
    assert sum(compared) < 900


def test_a_worker_gives_back_what_arrow_no_longer_uses():
    """Of batches that are done with, only the last is still there."""
    code = """
import re, pyarrow as pa, pyarrow.compute as pc
from textlabel.llm.common import slices

def taken():
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"Pss_Anon:\\s+(\\d+)", f.read())[1]) >> 10

def batches(n, rows):
    for i in range(n):
        yield pa.record_batch({"key": pa.array(range(rows)), "text": pa.array([f"{i} " + "some words, " * 80] * rows)})

for batch in batches(1, 10):
    list(slices(batch, 1 << 20))
before = taken()
for batch in batches(4, 20_000):
    for rows in slices(batch, 1 << 21):
        words = pc.split_pattern(rows.column(1), " ")
        met = words.values.dictionary_encode()
        del words, met, rows
print(taken() - before)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, check=True, cwd=Path(packing.__file__).parents[2])
    print(done.stdout)
    assert int(done.stdout) < 45


def test_words_go_when_another_operator_begins(spark):
    common.forget()
    encoder = packing.word_encoder(packing.word_path())
    encoder.encode("words that are remembered")
    assert packing.word_encoder(packing.word_path()) is encoder and len(encoder) == 4  # from task to task
    assert common.held("other", list) == [] and packing.word_encoder(packing.word_path()) is not encoder
    class Frame:  # gives the function that would run on the workers
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("_text", T.StringType())])
        select = lambda self, *_: self
        mapInArrow = lambda self, run, _: run

    encoder = packing.word_encoder(packing.word_path())
    batch = pa.record_batch({"doc_id": [1, 2], "_text": ["abc", None]})
    run = common.map_texts(Frame(), "doc_id", "text", [T.StructField("n", T.LongType())], lambda texts: (pa.array(map(len, texts)),))
    assert [b.column(1).to_pylist() for b in run([batch])] == [[3, 0]]
    assert packing.word_encoder(packing.word_path()) is not encoder
