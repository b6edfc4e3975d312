"""Mixture of sources against doing it row by row."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from changecapture.llm import mixture as op

SCHEMA = "doc_id long, text string, source string"


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight; those above the limit stop, and the excess is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    left = sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not above:
            return target | {s: weight[s] * level for s in open_}
        for s in above:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def brute(rows, most=3, passes=4):
    """Copies of each row (source, id, text, number among equal rows)."""
    size = {}
    seen = Counter()
    for doc_id, text, source in rows:
        text = text or ""
        seen[doc_id, text, source] += 1
        size[source, doc_id, text, seen[doc_id, text, source]] = len(
            re.findall("[^\x20\x09-\x0d]+", text)
        )
    sizes = defaultdict(int)
    for key, n in size.items():
        sizes[key[0]] += n
    targets = brute_targets(sizes, most=most)
    copies = {}
    for source, target in targets.items():
        own = [k for k in size if k[0] == source]
        rho = target / sizes[source] if sizes[source] else 0
        whole, chance = int(min(most, rho)), min(most, rho) - int(min(most, rho))
        copies.update(dict.fromkeys(own, whole))
        if not chance:
            continue
        rank = {}
        for k in own:
            _, doc_id, text, number = k
            name = hashlib.sha256(text.encode()).hexdigest()[:32]
            seed = f"{'-' if doc_id is None else doc_id}|{name}|{number}"
            u = (int(hashlib.sha256(seed.encode()).hexdigest()[:12], 16) + 0.5) / (1 << 48)
            rank[k] = u / (1 - u) / (chance / (1 - chance))
        extra = set()
        gap = lambda: target - sum(size[k] * (whole + (k in extra)) for k in own)
        for _ in range(passes):
            room, upto = gap(), 0
            if room <= target * op.CLOSE:
                break
            for k in sorted((k for k in own if k not in extra and size[k] <= room), key=rank.get):
                upto += size[k]
                if upto > room:
                    break
                extra.add(k)
        left = [(size[k], rank[k], k) for k in own if k not in extra and 0 < size[k] < 2 * gap()]
        if left:
            extra.add(min(left, key=lambda x: x[:2])[2])
        for k in extra:
            copies[k] += 1
    return targets, {(k[1], k[2], k[0], n, size[k]): 0 for k, n in copies.items()}, copies, size


def corpus(seed, n, sources):
    rng = random.Random(seed)
    return [
        (i, " ".join("w" for _ in range(int(rng.paretovariate(1.1)) % 300)), rng.choice(sources))
        for i in range(n)
    ]


@pytest.mark.parametrize("seed,n,sources", [(1, 300, ["a", "b", "c", None]), (2, 60, ["Z", "a", "é", "z", "b"])])
def test_brute_force(spark, seed, n, sources):
    rows = corpus(seed, n, sources)
    rows += [(None, "x y z", "a"), (None, None, None), (5, "", "a"), *[(7, "one two", "a")] * 9]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("size", "copies", "rank", "target", "weight", "_mix_key"):
        docs = docs.withColumn(name, F.lit("clash"))
    got = op.allocate(docs).collect()
    targets, _, copies, size = brute(rows)
    want = Counter(
        (k[1], k[0], hashlib.sha256(k[2].encode()).hexdigest()[:32], size[k], n) for k, n in copies.items()
    )
    assert Counter((r.doc_id, r.source, r.text_name, r.size, r.copies) for r in got) == want
    for r in got:
        assert r.target == pytest.approx(targets[r.source])
        assert r.taken == r.size * r.copies <= 3 * r.size
    assert Counter(map(tuple, op.allocate(docs).collect())) == Counter(map(tuple, got))


def test_targets_stop_and_the_excess_is_shared(spark):
    sizes = {"a": 10, "b": 1000, "c": 1, "d": 50, "e": 5000, None: 0, "f": 300}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in op.targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_targets_are_met(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = op.allocate(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))
    for r in rows.collect():
        assert abs(r.taken - r.target) <= 0.02 * r.target


def test_the_mixed_table_holds_every_copy(spark):
    rows = corpus(3, 80, ["a", "b", "c"]) + [(900, "same words here", "a")] * 5
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("more", F.col("doc_id") + 1)
    mixed = op.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter((r.doc_id, r.source, r.more) for r in mixed.collect())
    want = Counter()
    for r in op.allocate(docs).collect():
        want[r.doc_id, r.source, r.doc_id + 1] += r.copies
    assert got == +want


def test_heavier_documents_are_taken_more_often(spark):
    """Inclusion is in proportion to the weight; nothing is taken more than three times."""
    rows = [(i, "w " * 20 + str(i), "ab"[i % 2], 1.0 if i % 4 < 2 else 3.0) for i in range(4000)]
    rows += [(9000, "never taken", "a", 0.0), (9001, "nor this", "a", None)]
    docs = spark.createDataFrame(rows, SCHEMA + ", quality double")
    got = op.allocate(docs, weight_column="quality").collect()
    taken = defaultdict(list)
    for r in got:
        if r.doc_id < 9000 and r.source == "b":
            taken[r.doc_id % 4 < 2].append(r.copies)
        assert r.copies <= 3 and (r.doc_id < 9000 or r.copies == 0)
    mean = {k: sum(v) / len(v) for k, v in taken.items()}
    assert mean[False] == pytest.approx(3 * mean[True], rel=0.15)


def test_samples_of_one_source_are_even(spark):
    """Over the documents of a source, long and short ones are taken alike."""
    rows = [(i, "w " * (1 + i % 50), "ab"[i % 7 == 0]) for i in range(6000)]
    got = op.allocate(spark.createDataFrame(rows, SCHEMA)).where("source = 'b'").collect()
    target = got[0].target / got[0].source_size
    for side in (True, False):
        own = [r.copies for r in got if (r.size > 25) is side]
        assert sum(own) / len(own) == pytest.approx(target, abs=0.1)


@pytest.mark.parametrize("rows", [[], [(1, None, "a"), (2, "", None)]])
def test_no_words(spark, rows):
    got = op.allocate(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows) and all((r.taken, r.target) == (0, 0) for r in got)


def test_one_document_of_a_source(spark):
    got = op.allocate(spark.createDataFrame([(1, "a b c", "x"), (2, "d " * 100, "y")], SCHEMA)).collect()
    # 103 words by 5 and 2: x stops at 9, y takes the other 94 of its 100
    assert {r.doc_id: (r.taken, round(r.target)) for r in got} == {1: (9, 9), 2: (100, 94)}
