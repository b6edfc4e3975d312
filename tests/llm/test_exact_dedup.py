from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from changecapture.llm.exact_dedup import chunks_of, exact_groups
from changecapture.llm.queries import op8_exact_dedup
from conftest import plan

SCHEMA = "doc_id long, text string, keep_id int, at string"


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], SCHEMA)
    got = exact_groups(df, **options).drop("n_chunks").collect()
    return sorted(map(tuple, got), key=repr)


def brute(rows):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    groups = defaultdict(set)
    for i, t in rows:
        groups[(t or "").translate(lower)].add(i)
    out = set()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        out |= {(i, keep, len(ids), i == keep, sha) for i in ids}
    return sorted(out, key=repr)


ROWS = [
    (1, "Same. Text\n" * 900), (2, "same. text\n" * 900), (3, "same. text\n" * 899),
    (4, "ÄB"), (5, "äb"), (6, "Äb"), (7, None), (8, ""), (None, "x"), (9, "X"),
    (10, "a" * 20_000), (11, "a" * 20_000), (12, "a" * 20_001), (None, "alone"),
    (13, "same id"), (13, "other text"), (14, "row"), (14, "row"), (15, "tab\tend\n"), (16, "tab\tend"),
]


def test_equals_brute_force(spark):
    assert run(spark, ROWS) == brute(ROWS)


def test_names_may_collide(spark):
    rows = [(1, "a." * 2000), (2, "a." * 2000), (3, "b." * 2000), (4, "ab" * 2000), (5, "c"), (6, "d")]
    name = lambda chunk: F.length(chunk).cast("string").cast("binary")
    assert run(spark, rows, chunk_name=name) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("text", ["", "x", "a.b\n" * 3000, "é😀" * 9000, "\n" * 5000])
def test_chunks_are_the_text(spark, text):
    df = spark.createDataFrame([(text,)], "text string").select(chunks_of(F.col("text")).alias("c"))
    parts = df.first()["c"]
    assert "".join(parts) == text
    assert all(len(p) <= 8193 for p in parts)
    assert all(len(p) > 1024 for p in parts[:-1])


def test_chunk_texts_are_shuffled_once(spark):
    rows = [(i, "Same. Text\n" * 400 + str(i)) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    text = plan(exact_groups(docs), "simple")
    # the result joins tables that hold recipes, no chunk texts
    assert "chunk#" not in text and "Python" not in text


def test_the_query_returns_and_counts_each_row(spark, tmp_path):
    rows = [(None, "x")] * 5000 + [(9, "X"), (14, "Row"), (14, "row"), (None, None), (None, ""), (1, "alone")]
    long_ = "Same. Text\n" * 900
    rows += [(2, long_), (2, long_), (3, long_)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    done = op8_exact_dedup(spark, str(tmp_path))
    got = done.groupBy("doc_id", "keep_id", "group_size").count().collect()
    want = {(None, 9, 5001, 5000), (9, 9, 5001, 1), (14, 14, 2, 2), (None, None, 2, 2), (1, 1, 1, 1), (2, 3, 3, 2), (3, 3, 3, 1)}
    assert set(map(tuple, got)) == want
    kept = done.where("kept").groupBy("text_sha256", "doc_id").count().collect()
    assert sorted((r["doc_id"] or 0, r["count"]) for r in kept) == [(0, 1), (1, 1), (3, 1), (9, 1), (14, 1)]
