from __future__ import annotations

import random

import pytest
import sentencepiece

from changecapture.llm.queries import SENTENCEPIECE_MODEL
from changecapture.llm.sentencepiece_scan import (
    FRESH,
    Coder,
    best_states,
    chunks,
    combine,
    decode,
    encode,
    load,
    marked,
)

ALPHABET = "  \n\taeiouthndrs.é漢😀0123 ABC-_ "


@pytest.fixture(scope="module")
def vocabulary():
    return load(SENTENCEPIECE_MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=SENTENCEPIECE_MODEL)


def texts(n, seed=1):
    rng = random.Random(seed)
    words = ["the", "Haus", "été", "international", "x1y2", "…", "def f(x):", "漢字", "    ", "aaaa"]
    out = ["", " ", "a", "  a  b ", "\n\n", "▁ literal", " " * 50 + "x" + " " * 31]
    for _ in range(n):
        size = rng.randint(1, 50)
        if rng.random() < 0.5:
            out.append("".join(rng.choice(ALPHABET) for _ in range(size)))
        else:
            out.append(rng.choice(["", " ", "\n"]).join(rng.choice(words) for _ in range(size)))
    return out


def test_equals_the_library(vocabulary, library):
    coder, rows = Coder(vocabulary), texts(1500)
    assert [coder.encode(t) for t in rows] == library.encode(rows)


@pytest.mark.parametrize("size", [1, 2, 5, 17, 64])
def test_chunks_equal_the_whole(vocabulary, library, size):
    coder = Coder(vocabulary)
    for text in texts(150, size):
        if not text:
            continue
        parts = chunks(marked(text), size, vocabulary.longest)
        assert "".join(b for _, b, _ in parts) == marked(text)
        states = best_states([coder.transfer(*p) for p in parts])
        found = [i for p, a, b in zip(parts, states[:-1], states[1:], strict=True) for i in coder.trace(*p, a, b)]
        assert found == library.encode(text)


def test_products_are_associative(vocabulary):
    coder = Coder(vocabulary)
    parts = chunks(marked("internationalisation ohne Blanks" * 3), 7, vocabulary.longest)
    a, b, c, *_ = (coder.transfer(*p) for p in parts)
    assert combine(combine(a, b), c) == combine(a, combine(b, c))
    assert all(weight == 0 for weight in a.values()) and all(s == FRESH for s, _ in a)


def test_tables(spark, vocabulary, library):
    rows = texts(60, 9)
    rows = [(i, t, "x", 1) for i, t in enumerate(rows)]
    rows += [(None, "no id", "x", 1), (5, "again", "x", 1), (77, None, "x", 1)]
    giant = ("unbroken" * 40 + " and some words\n") * 3
    rows += [(99, giant, "x", 1), (99, giant, "x", 1), (None, giant + "!", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, no int")
    got = encode(df, vocabulary, chunk=100)
    want = [(i, library.encode(t or "")) for i, t, *_ in rows]
    assert sorted([(r.doc_id, r.ids) for r in got.collect()], key=repr) == sorted(want, key=repr)
    back = decode(got.withColumnRenamed("text_hash", "no"), vocabulary)
    assert back.columns == ["doc_id", "no", "text"]
    want = [(i, (t or "").replace("▁", " ")) for i, t, *_ in rows]
    assert sorted([(r.doc_id, r.text) for r in back.collect()], key=repr) == sorted(want, key=repr)


def test_decoding_odd_ids(spark, vocabulary, library):
    first = vocabulary.first_byte
    ids = [[first + 0xE6, first + 0xBC, 1500], [first + 65], [], None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in decode(df, vocabulary).collect()}
    assert got[1] == "A" and got[2] == "" and got[3] == ""
    assert "�" in got[0]


def test_empty_table(spark, vocabulary):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert decode(encode(df, vocabulary), vocabulary).collect() == []
    with pytest.raises(ValueError):
        encode(df, vocabulary, chunk=0)


def test_a_word_is_searched_once_whatever_mark_follows(monkeypatch):
    coder = Coder(load(SENTENCEPIECE_MODEL))
    searched, search = [], coder._pieces
    monkeypatch.setattr(coder, "_pieces", lambda t: searched.append(t) or search(t))
    text = "zxqwords zxqwords, zxqwords*** zxqwords. (zxqwords) a  , ▁, ,,  ... 'zxqwords'\n,x, é€, 𝄞! don't, l'été."
    model = sentencepiece.SentencePieceProcessor(model_file=SENTENCEPIECE_MODEL)
    for t in (text, " ".join(reversed(text.split(" "))), text * 3):
        assert coder.encode(t) == model.encode(t)
        assert coder.decode(coder.encode(t)) == model.decode(model.encode(t))
    assert searched.count("▁zxqwords") == 1 and "▁zxqwords***" not in searched
