from __future__ import annotations

import random

import pytest

from changecapture.llm import decontaminate
from changecapture.llm.decontaminate import contaminated, drop_contaminated, passages
from changecapture.llm.queries import op10_decontamination

SCHEMA = "doc_id long, text string, item_ids string, share string"
ITEMS = [
    (1, "A train leaves Paris at 9 with 120 people and 30 kg of mail, while Anna waits in Lyon for Paris mail."),
    (2, "Short one here."),
    (3, None),
    (4, ""),
    (5, "If Tom has 3 apples and Tom eats 2 apples, how many apples does Tom have in the end?"),
]
FILL = "Some other text stands before and after it. "


def run(spark, docs, items=ITEMS, **options):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contaminated(df, bench, **options)
    assert got.columns == ["doc_id", "contaminated", "item_ids", "share"]
    return [(r.doc_id, r.item_ids) for r in got.collect() if r.contaminated == bool(r.item_ids)]


DOCS = [
    (10, FILL + ITEMS[0][1] + FILL),
    (11, FILL + ITEMS[0][1].replace("Paris", "Berlin").replace("9", "11").replace("120", "7") + FILL),
    # one name becomes several: the same form, but no re-parameterised copy
    (12, "If Mia has 5 apples and Tom eats 4 apples, how many apples does Ann have in the end?"),
    (13, FILL + "A train leaves Paris at 9 with 120 people. " + FILL),
    (14, "Well, " + ITEMS[1][1].lower()),
    (15, "a short one is not here"),
    (16, ITEMS[4][1].replace("Tom", "Mia").replace("3", "5").replace("apples", "pears")),
    (17, ITEMS[4][1].replace("Tom", "Mia").replace(" 3 ", " 5 ").replace(" 2 ", " 4 ")),
    (18, ITEMS[0][1].upper()),
    (19, None), (20, ""), (21, "12 12 12 12 12 12 12 12 12 Tom"), (None, FILL + ITEMS[4][1]),
    (22, FILL * 20_000 + ITEMS[4][1]), (10, "another text of the same id"), (17, ITEMS[4][1]), (17, ITEMS[4][1]),
]
WANT = [
    (10, [1]), (11, [1]), (12, []), (13, []), (14, [2]), (15, []), (16, []), (17, [5]), (18, [1]), (19, []),
    (20, []), (21, []), (None, [5]), (22, [5]), (10, []), (17, [5]), (17, [5]),
]


@pytest.mark.parametrize("sent", [4_000_000, 0])
def test_cases(spark, sent):
    assert sorted(run(spark, DOCS, sent=sent), key=repr) == sorted(WANT, key=repr)


def test_filter(spark):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in DOCS], SCHEMA)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert kept.count() == sum(not found for _, found in WANT)


def test_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, DOCS[:2], []) == [(10, []), (11, [])]
    assert run(spark, DOCS[:2], [(3, None)]) == [(10, []), (11, [])]


def test_items_that_repeat(spark):
    items = [(1, ITEMS[0][1]), (1, ITEMS[0][1]), (None, ITEMS[0][1]), (7, ITEMS[0][1])]
    assert run(spark, DOCS[:1], items) == [(10, [1, 7])]
    df = spark.createDataFrame(DOCS[:1], "doc_id long, text string")
    unnamed = spark.createDataFrame(items[2:3], "item_id long, text string")
    (row,) = contaminated(df, unnamed).collect()
    assert row.contaminated and row.item_ids == []


def test_whole_tables_against_brute_force(spark, data):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()}
    plain = lambda t: " ".join(t.lower().split())
    want = {
        (d, i) for d, text in docs.items() for i, item in items.items() if plain(item) in plain(text)
    }
    got = op10_decontamination(spark, data).collect()
    assert len(got) == len(docs) and want
    found = {(r.doc_id, i) for r in got for i in r.item_ids}
    assert found >= want and len(found - want) <= 0.02 * len(docs)


ANNA = "Anna has 12 red apples. Anna buys 7 green ones. Anna eats 4 of them."


def test_names_that_open_sentences_and_longer_values(spark):
    items = [(1, ANNA), (2, "Then the man called Tom went 30 miles from home to see his old friend Tom there."), (3, "Anna has 12 red apples.")]
    second = items[1][1]
    docs = [
        (1, FILL + ANNA.replace("Anna", "Maria") + FILL),
        (2, FILL + ANNA.replace("Anna", "Mary Ann").replace("12", "one hundred and five") + FILL),
        (3, "Question: " + ANNA.replace("Anna", "Maria")),
        (4, second.replace("Tom", "Mary Ann").replace("30", "twenty five")),
        (5, second.replace("Tom", "Mary Ann", 1).replace("Tom", "Bob")),
        (6, "Anna has 12 red apples. Maria buys 7 green ones. Zoe eats 4 of them."),
        (7, ANNA.lower()),
        (8, "No one here has seen such things before, and nobody asked."),
    ]
    want = [(1, [1, 3]), (2, [1, 3]), (3, [1, 3]), (4, [2]), (5, []), (6, [3]), (7, [1, 3]), (8, [])]
    assert sorted(run(spark, docs, items + [(4, "Short one here.")])) == want


def test_items_of_numbers(spark):
    numbers = "Compute 12 + 34 + 56 + 78 + 90 + 11."
    table = "Sum the rows of this short table of values for me. " + " ".join(map(str, range(100, 140)))
    items = [(1, numbers), (2, "3 km 40 m 5 cm 6 mm 7 km 80 m 9 cm 1 mm 2 kg"), (3, "1984"), (4, table)]
    docs = [
        (1, FILL + numbers + FILL),
        (2, FILL + numbers.replace("56", "57") + FILL),
        (3, "It is " + items[1][1] + " to the end"),
        (4, "It was in 1984, they say."),
        (5, "Values: " + " ".join(map(str, range(102, 140)))),
        (6, "Values: " + " ".join(map(str, range(139, 99, -1)))),
    ]
    assert sorted(run(spark, docs, items)) == [(1, [1]), (2, []), (3, [2]), (4, [3]), (5, [4]), (6, [])]


def test_passages_of_a_long_item(spark):
    words = [f"w{a}{b}" for a in "abcdefghijklmnopqrst" for b in "vwxyz"]
    named = list(words)
    named[5::6] = ["Tom"] * len(named[5::6])
    items = [(1, ITEMS[0][1]), (2, " ".join(words)), (3, " ".join(named).replace("w", "q"))]
    other = items[2][1].split()
    put = lambda tokens, name: " ".join(tokens).replace("Tom", name)
    docs = [
        (1, FILL + "A train leaves Paris at 9 with 120 people and 30 kg of. " + FILL),
        (2, FILL + "A train leaves Paris at 9 with 120 people and 30 kg. " + FILL),
        (3, "see " + " ".join(words[40:53]) + " there"),
        (4, "see " + " ".join(words[40:52]) + " there"),
        (5, "see " + put(other[10:36], "Mia") + " there"),
        (6, "see " + put(other[10:30], "Mia") + " there"),
        # two passages with a name each, on one diagonal
        (7, put(other[:31], "Mia") + " " + put(other[31:61], "Ann")),
        (8, put(other[:20], "Mia") + " " + put(other[20:40], "Ann")),
    ]
    want = [(1, [1]), (2, []), (3, [2]), (4, []), (5, [3]), (6, []), (7, [3]), (8, [])]
    assert sorted(run(spark, docs, items)) == want


def test_passages():
    line = lambda at, *pairs: (at, 8, list(pairs))
    assert passages([line(i) for i in range(6)], 13) == set(range(6))
    assert passages([line(i) for i in range(5)], 13) == set()
    assert passages([line(0), line(8), line(17)], 16) == {0, 8}
    mixed = [line(i, ("a", "x")) for i in range(6)] + [line(i, ("a", "y")) for i in range(6, 20)]
    assert passages(mixed, 14) == set(range(6, 20))
    assert passages(mixed, 13) == set(range(20))
    assert passages([line(0, ("a", "x"), ("a", "y"))], 8) == set()


def test_keys_lose_no_window():
    """Texts without a key have no window of the benchmark, in any view, whatever stands between."""
    rng = random.Random(11)
    words = ["apples", "Anna", "12", "red", "buys", "kg", "twelve", "the", "İstanbul", "ΟΔΟΣ", "of", "Tom"]
    marks = [" ", " ", " ", ", ", ". ", "\n", " (", "; "]
    text = lambda n: "".join(rng.choice(words) + rng.choice(marks) for _ in range(n))
    for literals in (1, 4):
        make = decontaminate.Templates(4, literals)
        for _ in range(40):
            item = text(rng.randrange(1, 9))
            windows = list(make.asked(item))
            keys = {
                decontaminate._key(of, p, width) for _, width, of, at, _ in windows for p in at.tolist()
            }
            wanted = {(view, width, h) for view, width, _, _, hs in windows for h in hs.tolist()}
            near = decontaminate.Keys(sorted(keys)) if keys else None
            for _ in range(40):
                doc = text(rng.randrange(1, 12)) + rng.choice(["", item.upper(), item])
                views = make(doc, decontaminate.VIEWS)
                met = {
                    (view, width, h)
                    for view, width, _ in wanted
                    for h in make.windows(views[view], view, width)[1].tolist()
                }
                if met & wanted:
                    assert near(doc)
