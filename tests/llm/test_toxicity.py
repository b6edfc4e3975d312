from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from changecapture.llm.queries import op6_toxicity
from changecapture.llm.toxicity import (
    EXACT,
    MISSPELLED,
    NOTHING,
    Matcher,
    Model,
    fit,
    lexicon_of,
    quoted,
    score,
)

SCHEMA = "doc_id long, text string, toxic int, score string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_equals_the_distance():
    rng = random.Random(3)
    terms = ["abcab$", "bcabb$", "ca$", "abba$", "stemm", "bab$"]
    match = Matcher(terms)
    for _ in range(4000):
        word = "".join(rng.choice("abcstem") for _ in range(rng.randint(0, 8)))
        if rng.random() < 0.5:
            word = list(rng.choice(terms).strip("$"))
            for _ in range(rng.randint(0, 2)):
                word[rng.randrange(len(word)) : rng.randrange(len(word) + 1)] = rng.choice(["a", "", "xy"])
                word = word or ["a"]
            word = "".join(word)
        ends = [t[:-1] for t in terms if t.endswith("$")]
        if word in ends or word.startswith("stemm"):
            want = EXACT
        elif any(len(t) >= 5 and distance(word, t) <= 1 for t in ends):
            want = MISSPELLED
        else:
            want = NOTHING
        assert match(word) == want, word


def test_lexicon_has_words_and_stems():
    nodes = {}

    def add(word, toxic, other):
        for i in range(1, len(word) + 1):
            t, o = nodes.get(word[:i], (0, 0))
            nodes[word[:i]] = t + toxic, o + other

    for word in ("clown$", "class$"):
        add(word, *((40, 0) if word == "clown$" else (0, 90)))
    for tail in ("ab$", "cd$", "ef$", "gh$"):
        add("stinky" + tail, 6, 0)
    add("rare$", 2, 0)
    add("the$", 60, 600)
    assert lexicon_of(nodes) == ["clown$", "stinky"]


def test_quotation():
    text = 'he said "what an idiot you are" and left'
    at = text.index("idiot")
    assert quoted(text, at, at + 5)
    assert not quoted('what an idiot "you" are', 8, 13)
    assert quoted("„so ein idiot“, sagte er", 8, 13) and quoted("«quel idiot»", 6, 11)
    assert not quoted('"one" idiot "two"', 6, 11) and not quoted('"idiot\nnext" line', 1, 6)


@pytest.fixture(scope="module")
def fitted(spark):
    rng = random.Random(1)
    words = "plain words that mean nothing at all here today some more of them".split()
    rows = []
    for i in range(120):
        text = [rng.choice(words) for _ in range(30)]
        if i % 3 == 0:
            text[rng.randrange(30)] = rng.choice(["moron", "scumbag"])
        rows.append((i, " ".join(text), int(i % 3 == 0), "x"))
    df = spark.createDataFrame(rows, SCHEMA)
    return fit(df, df.unionByName(spark.createDataFrame([(5, None, None, "x"), (None, None, 1, "x")], SCHEMA)))


def test_scores(spark, fitted):
    assert fitted.terms == ["moron$", "scumbag$"]
    rows = [
        (1, "you moron", 1, "x"), (2, "you mor0n, you scumbags", 1, "x"), (3, "more on this", 0, "x"),
        (4, None, 0, "x"), (5, "", 0, "x"), (None, "MORON", 0, "x"),
        (6, "they wrote \"moron\" on the wall", 0, "x"), (6, "they wrote \"moron\" on the wall", 0, "x"),
        (7, "fine " * 300_000 + "moron", 0, "x"),
    ]
    got = score(spark.createDataFrame(rows, SCHEMA), fitted)
    assert got.columns == ["doc_id", "text", "toxic", "exact", "misspelled", "quoted", "score"]
    got = {(r.doc_id, i): r for i, r in enumerate(got.collect())}
    high = {k[0] for k, r in got.items() if r.score >= 0.7}
    assert high >= {1, None, 7} and not high & {3, 4, 5, 6}
    (two,) = [r for k, r in got.items() if k[0] == 2]
    assert (two.exact, two.misspelled, two.quoted) == (0, 2, 0)
    assert len(got) == len(rows)


def test_empty_tables(spark, fitted):
    none = spark.createDataFrame([], SCHEMA)
    assert score(none, fitted).collect() == []
    model = fit(none, none)
    assert model.terms == []
    rows = spark.createDataFrame([(1, "moron", 1, "x")], SCHEMA)
    assert score(rows, Model([], [0.0] * 4)).first().score == 0.5


def test_held_out(spark, data):
    got = op6_toxicity(spark, data)
    labels = spark.read.parquet(f"{data}/labels.parquet")
    both = got.join(labels, "doc_id").where("held_out")
    right, n = both.agg(F.avg((F.col("toxic") == F.col("predicted")).cast("double")), F.count("*")).first()
    assert n > 50 and right > 0.95


def test_swaps_are_one_edit():
    rng = random.Random(4)
    terms = ["abcab$", "bcabb$", "ca$", "abba$", "bab$"]
    match = Matcher(terms, swaps=True, short={"abba$"})
    for _ in range(4000):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(0, 7)))
        swapped = {word[:i] + word[i + 1] + word[i] + word[i + 2 :] for i in range(len(word) - 1)}
        near = {t[:-1] for t in terms if len(t) > 4 and (distance(word, t[:-1]) <= 1 or t[:-1] in swapped)}
        want = EXACT if word + "$" in terms else MISSPELLED if near else NOTHING
        assert match(word) == want, word


def test_misspelled_words_of_a_stem_and_of_four_letters(spark):
    rng = random.Random(2)
    words = "plain words that mean nothing at all here today some more of them".split()
    rows = []
    for i in range(240):
        text = [rng.choice(words) for _ in range(30)]
        if i % 3 == 0:
            text[rng.randrange(30)] = rng.choice(["idiot", "idiots", "idiotic", "scum", "jerk"])
        elif i % 6 == 1:
            text[rng.randrange(30)] = "perk"
        rows.append((i, " ".join(text), int(i % 3 == 0), "x"))
    df = spark.createDataFrame(rows, SCHEMA)
    model = fit(df, df)
    assert "idiot" in model.terms and {"idiot$", "idiots$", "idiotic$"} <= set(model.terms)
    assert model.short == ["scum$"]
    said = "idoit idi0t idiiot idoits idiotics scmu sccum perk jerkk".split()
    got = score(spark.createDataFrame([(i, w, 0, "x") for i, w in enumerate(said)], SCHEMA), model).collect()
    found = {r.text: (r.exact, r.misspelled) for r in got}
    assert found == {w: (0, 1) for w in said[:4] + said[5:7]} | {"idiotics": (1, 0), "perk": (0, 0), "jerkk": (0, 0)}
