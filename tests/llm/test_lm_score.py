from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from changecapture.llm.lm_score import WORD, _hashes, _packed_counts, score, stupid_backoff

SCHEMA = "doc_id long, text string, block int, n_words string"


def brute(rows, order, backoff):
    docs = [WORD.findall((t or "").lower()) for _, t in rows]
    grams = lambda ws: Counter(tuple(ws[i : i + n]) for n in range(1, order + 1) for i in range(len(ws) - n + 1))
    total = Counter()
    for ws in docs:
        total += grams(ws)
    size = sum(map(len, docs))
    out = []
    for (i, _), ws in zip(rows, docs, strict=True):
        rest, n = Counter(total), size - len(ws)
        rest.subtract(grams(ws))

        def chance(context, word, rest=rest, n=n):
            if not context:
                return (rest[word,] or 0.5) / max(n, 1)
            if rest[(*context, word)] and rest[context]:
                return rest[(*context, word)] / rest[context]
            return backoff * chance(context[1:], word)

        logs = [math.log(chance(tuple(ws[max(0, k - order + 1) : k]), w)) for k, w in enumerate(ws)]
        out.append((i, len(ws), round(sum(logs), 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("order, docs, grams", [(3, 5, 40), (1, 100, 10**6), (4, 1, 200)])
def test_equals_brute_force(spark, order, docs, grams):
    rng = random.Random(order)
    words = "a b c The the x1 é d e".split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 25)))) for i in range(30)]
    rows += [(None, "null id"), (40, None), (41, ""), (42, "?!"), rows[3], rows[3], (3, "same id")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    got = score(df, order=order, block_docs=docs, partition_grams=grams).collect()
    found = sorted([(r.doc_id, r.n_words, round(r.log_score, 6)) for r in got], key=repr)
    assert found == brute(rows, order, 0.4)
    assert all((r.per_word is None) == (r.n_words == 0) for r in got)


def test_empty_table(spark):
    assert score(spark.createDataFrame([], SCHEMA)).collect() == []


def test_words_shared_by_all_documents(spark):
    rows = [(i, "the " * 30 + f"w{i}") for i in range(200)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    got = score(df, block_docs=10, partition_grams=50).collect()
    found = sorted([(r.doc_id, r.n_words, round(r.log_score, 6)) for r in got], key=repr)
    assert found == brute(rows, 3, 0.4)


def test_packing():
    hashes = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2))
    packed, _ = _packed_counts(hashes, np.ones(len(hashes)))
    assert (_hashes(packed) == hashes).all()


def test_backoff():
    logs = stupid_backoff([np.array([2.0, 0.0, 4.0]), np.array([0.0, 0.0])], 8)
    assert np.allclose(np.exp(logs), [2 / 8, 0.4 * 0.5 / 8, 0.4 * 4 / 8])
