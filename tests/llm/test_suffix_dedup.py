from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from changecapture.llm import suffix_dedup
from changecapture.llm.suffix_dedup import Anchors, cut, drop_repeated_bytes

SCHEMA = "doc_id long, text string, at int, _id string"


def brute(texts, length):
    """Windows of every text, counted; bytes covered by one that occurs twice."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def run(spark, texts, length, seed, ids=None, together=32):
    ids = ids or list(range(len(texts)))
    rows = [(i, t, 1, "x") for i, t in zip(ids, texts, strict=True)]
    got = drop_repeated_bytes(spark.createDataFrame(rows, SCHEMA), length, seed, together).collect()
    return [
        (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
        for r in got
    ]


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 5)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(30) for _ in range(4)]
    docs = [None, "", "short", "a" * 300, "ab" * 90, "a" * 150]
    for _ in range(40):
        parts = [rng.choice([text(rng.randint(1, 40)), rng.choice(passages)]) for _ in range(3)]
        doc = " ".join(parts)
        at = rng.randrange(len(doc))
        docs += [doc, doc[:at] + "Z" + doc[at:], doc[: rng.randrange(len(doc))]]
    return docs + [docs[8]] * 3


@pytest.mark.parametrize("length, seed, together", [(40, 13, 4096), (40, 13, 2), (25, 25, 8), (30, 1, 4096)])
def test_equals_brute_force(spark, length, seed, together):
    texts = corpus(length)
    got = run(spark, texts, length, seed, together=together)
    assert sorted(got) == sorted((i, *x) for i, x in enumerate(brute(texts, length)))
    assert any(n for _, _, n, _, _ in got) and any(k > 1 for *_, k, _ in got)


def test_null_and_repeated_ids_and_rows(spark):
    long, other = "x1y2z3 " * 2 + "w" * 30, "".join(chr(97 + i % 26) for i in range(45))
    texts, ids = [long, long, other, other + "?", "tail"], [None, None, 7, 7, None]
    got = run(spark, texts, 40, 13, ids)
    want = [(i, *x) for i, x in zip(ids, brute(texts, 40), strict=True)]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_empty_table(spark):
    assert run(spark, [], 40, 13) == []


def test_equal_windows_have_equal_anchors_across_blocks():
    data = bytes(random.Random(1).choices(b"abcd", k=3000))
    whole, pieces = Anchors(50, 12), Anchors(50, 12, block=100)
    assert [x.tolist() for x in whole.of(data)] == [x.tolist() for x in pieces.of(data)]
    inner = Anchors(50, 12).of(data[500:1500])[0] + 500
    assert set(inner.tolist()) <= set(whole.of(data)[0].tolist())


def test_cut():
    assert cut(b"0123456789", [2, 1, 6], [4, 3, 10]) == (7, 2, b"045")
    assert cut(b"0123", [0], [4]) == (4, 1, b"")
    assert cut(b"0123", [], []) == (0, 0, b"0123")
    assert cut(b"0123456", [1, 3], [3, 5]) == (4, 1, b"056")


def test_rows_that_repeat_are_compared_once(spark):
    """A row with many copies gives its surroundings to the task of a seed once."""
    texts = corpus(40)
    texts += [texts[8]] * 600
    ids = [*range(len(texts) - 600), *[8] * 600]
    got = run(spark, texts, 40, 13, ids)
    assert sorted(got) == sorted((i, *x) for i, x in zip(ids, brute(texts, 40), strict=True))


def test_adjacent_copies_are_read_once():
    import pyarrow as pa
    import zstandard

    text = b"0123456789" * 8
    wanted = [{"seed": 1, "classes": 2, "n": 1, "o1": 3, "o2": 4, "d_lo": 0, "d_hi": 0, "at": 0}]
    batch = pa.RecordBatch.from_pylist([{"packed": zstandard.compress(text), "wanted": wanted}] * 50)
    out = list(suffix_dedup._contents(40)([batch, batch]))
    assert sum(b.num_rows for b in out) == 1 and out[0].column("content")[0].as_py() == text[:40]


def test_rows_are_taken_apart_a_few_at_a_time():
    import pyarrow as pa
    import zstandard

    kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
    n, spans = 2000, [{"lo": 0, "hi": 4}, {"lo": 6, "hi": 8}]
    columns = [pa.array(range(n)), pa.array([zstandard.compress(b"0123456789")] * n), pa.array([spans] * n, kind)]
    batch = pa.RecordBatch.from_arrays(columns, ["_id", "packed", "spans"])
    out = list(suffix_dedup._cut([batch]))
    assert max(b.num_rows for b in out) <= 256
    assert [x for b in out for x in b.column("_id").to_pylist()] == list(range(n))
    assert {x for b in out for x in b.column("kept").to_pylist()} == {b"4589"}
