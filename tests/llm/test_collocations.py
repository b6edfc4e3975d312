"""Collocations against counting every phrase."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from changecapture.llm import collocations as op


def brute(rows, least, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    counts[lang, tuple(words[i : i + m])] += 1
    frequent = {k: f for k, f in counts.items() if len(k[1]) > 1 and f >= least}
    inside = set()
    for (lang, p), f in frequent.items():
        for i in range(len(p)):
            for j in range(i + 2, len(p) + 1):
                if j - i < len(p) and f >= counts[lang, p[i:j]]:
                    inside.add((lang, p[i:j]))
    by_lang = {}
    for (lang, p), a in frequent.items():
        if (lang, p) in inside:
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = counts[lang, p[:k]], counts[lang, p[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        row = (-score, -a, " ".join(p).encode(), left, right)
        by_lang.setdefault(lang, []).append(row)
    out = set()
    for lang, own in by_lang.items():
        for rank, (s, a, p, left, right) in enumerate(sorted(own)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed, n=60):
    """Zipf words, and phrases that come whole; ends of pieces anywhere."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "ü", "x\x1cy"]
    weights = [1 / (i + 1) for i in range(len(words))]
    fixed = ["Alpha beta", "gamma delta of w0", "w0 w1 rare one two", "same same same same"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(60)):
            parts += rng.choices(words, weights) if rng.random() < 0.8 else [rng.choice(fixed)]
            parts.append(rng.choice([" ", " ", "  ", "\t", ". ", "\n", ","]))
        rows.append((rng.choice(["en", "de", None]), "".join(parts)))
    return rows


@pytest.mark.parametrize(
    "seed,least,top,shares,size,bits",
    [
        (1, 3, 10, (1 / 64, 1 / 8, 1.0), 1 << 20, 1 << 20),
        (2, 3, 5, (0.01, 0.05, 0.2, 0.5, 1.0), 64, 1 << 16),
        # hardly any bits: nearly every one is set by chance
        (3, 4, 1000, (0.1, 0.3, 1.0), 200, 64),
        (4, 2, 3, (1.0,), 1, 1 << 16),
    ],
)
def test_brute_force(spark, seed, least, top, shares, size, bits):
    rows = corpus(seed)
    rows += [(None, None), ("en", ""), ("en", " \t.. "), ("und", "Alpha beta"), *rows[:5]]
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("f", F.lit("x"))
    docs = docs.withColumn("phrase", F.lit(1)).withColumn("words", F.lit(2))
    done = op.collocations(docs, least=least, top=top, shares=shares, size=size, bits=bits)
    want = brute(rows, least, top)
    assert found(done) == want and want


def test_rounds_end_once_all_places_are_settled(spark, monkeypatch):
    """Phrases of rare words fill the places, so the frequent words are never opened."""
    rows = [("en", f"left{i} right{i}. the of. the of. the of") for i in range(8) for _ in range(3)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    opened = []
    pairs = op._pairs
    monkeypatch.setattr(op, "_pairs", lambda *a: opened.append(1) or pairs(*a))
    done = op.collocations(docs, least=3, top=8, shares=(0.3, 1.0), bits=1 << 16)
    assert found(done) == brute(rows, 3, 8) and len(opened) == 1
    done = op.collocations(docs, least=3, top=9, shares=(0.3, 1.0), bits=1 << 16)
    assert found(done) == brute(rows, 3, 9) and len(opened) == 3


def test_products_beyond_64_bits(spark):
    big = 10**12
    cuts = spark.createDataFrame(
        [("en", "a b", big, 1, "a", "b")], "lang string, phrase string, a long, k int, head string, rest string"
    )
    counts = spark.createDataFrame([("en", "a", 2 * big), ("en", "b", 3 * big)], "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 7 * big + 1)], "lang string, n long")
    assert op._scored(cuts, counts, totals).first()["score"] == 1000 * big * (7 * big + 1) // (6 * big * big)


@pytest.mark.parametrize("rows", [[], [("en", "a b c")], [(None, None)]])
def test_nothing_frequent(spark, rows):
    docs = spark.createDataFrame(rows, "lang string, text string")
    done = op.collocations(docs)
    assert done.count() == 0 and done.columns[:3] == ["lang", "rank", "phrase"]


def test_a_long_text_is_one_line(spark):
    """A text of many slices, without an end of a piece and with a word longer than a slice."""
    text = "ab cd " * 3000 + "x" * 5000 + " ab cd" * 100
    docs = spark.createDataFrame([("en", text)], "lang string, text string")
    done = op.collocations(docs, least=50, size=512, bits=1 << 16)
    assert found(done) == brute([("en", text)], 50, 2000)


def test_shares_must_grow_to_one(spark):
    docs = spark.createDataFrame([("en", "a")], "lang string, text string")
    with pytest.raises(ValueError):
        op.collocations(docs, shares=(0.5, 0.2, 1.0))
