"""Alignment of two tokenizers against the libraries and byte offsets, token by token."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from changecapture.llm import token_alignment as op
from changecapture.llm.queries import BYTE_BPE, SENTENCEPIECE_MODEL

TEXTS = [
    None,
    "",
    " ",
    "plain words, and 1234 numbers",
    "  two  blanks\n\nand lines\t",
    "café naïve 日本語 🙂 ü",
    "a mark ▁ that B cannot keep",
    "<|endoftext|> and <s> </s> <0x41>",
    "x" * 300,
    "\x00 zero\x7f",
    "é composed é",
    "don't we'll",
]


@pytest.fixture(scope="module")
def vocabularies():
    return op.load_byte_bpe(BYTE_BPE), op.load_pieces(SENTENCEPIECE_MODEL)


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=SENTENCEPIECE_MODEL)


def brute_tokens(libraries, text):
    """Ids and bytes of both sides; none where a side does not come out as the text."""
    a, b = libraries
    if not text:
        return [], []
    letters = op.byte_letters()
    one = [
        (i, bytes(letters[c] for c in a.id_to_token(i)))
        for i in a.encode(" " + text, add_special_tokens=False).ids
    ]
    two = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        two.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if any(b"".join(x for _, x in side) != whole for side in (one, two)):
        return [], []
    return one, two


def brute(libraries, texts):
    docs, counts = [], Counter()
    for text in texts:
        sides = brute_tokens(libraries, text)
        ends = [np.cumsum([len(x) for _, x in s]).tolist() for s in sides]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [
            [[i for (i, _), e in zip(s, es, strict=True) if low < e <= high] for s, es in zip(sides, ends, strict=True)]
            for low, high in zip([0, *cuts], cuts, strict=False)
        ]
        links = [
            (i, j)
            for (i, _), e in zip(sides[0], ends[0], strict=True)
            for (j, _), f in zip(sides[1], ends[1], strict=True)
            if e == f
        ]
        counts.update(links)
        docs.append((sides, groups, links))
    most = defaultdict(int)
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    out = []
    for sides, groups, links in docs:
        text = ";".join("|".join(",".join(map(str, s)) for s in g) for g in groups)
        out.append(
            (
                len(sides[0]), len(sides[1]), len(groups), len(links),
                sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return out


def run(spark, vocabularies, texts, **settings):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("a_ids", F.lit("clash"))
    aligned = op.align(docs.withColumn("block", F.lit(1)), *vocabularies, **settings)
    return rows, op.link_scores(aligned, most=50)


def test_brute_force(spark, data, vocabularies, libraries):
    texts = [r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("text").take(80)]
    texts = TEXTS + [t[:3000] for t in texts] + TEXTS[3:6] * 3
    rows, done = run(spark, vocabularies, texts)
    want = Counter((r[0], *w) for r, w in zip(rows, brute(libraries, texts), strict=True))
    assert Counter(map(tuple, done.collect())) == want


def test_parts_of_long_texts_change_nothing(spark, vocabularies, libraries):
    rng = random.Random(5)
    bits = ["word", " ", "  ", "\n", "é", "日本", ".", "12", "'ll", " a", "▁", "\t x"]
    texts = ["".join(rng.choices(bits, k=400)).replace("▁", "" if n % 3 else "▁") for n in range(30)]
    rows, done = run(spark, vocabularies, texts, size=16)
    want = Counter((r[0], *w) for r, w in zip(rows, brute(libraries, texts), strict=True))
    assert Counter(map(tuple, done.collect())) == want


def test_parts_join_to_the_text():
    text = "ab cd  ef\n gh " + "x" * 50 + " y z"
    for size in (1, 3, 10, 1000):
        assert " ".join(op.parts(text, size)) == text


def test_components_by_flooding():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randrange(1, 40)
        cuts = [sorted({n, *rng.sample(range(1, n + 1), rng.randrange(1, n + 1))}) for _ in "ab"]
        spans = [list(zip([0, *c], c, strict=False)) for c in cuts]
        group = list(range(sum(map(len, spans))))
        nodes = spans[0] + spans[1]
        for _ in nodes:
            for i, (s, e) in enumerate(nodes):
                for j, (t, f) in enumerate(nodes):
                    if s < f and t < e:
                        group[i] = group[j] = min(group[i], group[j])
        got = np.concatenate(op.components(*[np.array(c) for c in cuts]))
        assert len(set(zip(got.tolist(), group, strict=True))) == len(set(got.tolist())) == len(set(group))


def test_long_chains(spark, vocabularies, libraries):
    """A text whose tokens hardly ever end together, and one very long word."""
    texts = ["日本語" * 400, "ab" * 3000]
    rows, done = run(spark, vocabularies, texts)
    want = Counter((r[0], *w) for r, w in zip(rows, brute(libraries, texts), strict=True))
    assert Counter(map(tuple, done.collect())) == want


def test_arrays(spark, vocabularies, libraries):
    """Groups as lists; ids of more than two bytes are packed, too."""
    texts = [*TEXTS, "日本語" * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in op.unpacked(op.align(docs, *vocabularies)).collect():
        a, b = brute_tokens(libraries, texts[r.doc_id])
        assert (r.a_ids, r.b_ids) == ([i for i, _ in a], [i for i, _ in b])
        ends = [np.cumsum([len(x) for _, x in s])[np.cumsum(n) - 1].tolist() if n else [] for s, n in ((a, r.a_sizes), (b, r.b_sizes))]
        assert ends[0] == ends[1]
    values, counts = np.array([70000, 1, 2]), np.array([1, 0, 2])
    assert op._numbers(op._packed(values, counts), counts).tolist() == values.tolist()
    assert op._numbers(op._packed(values[1:], counts[1:], op.SHORT), counts[1:]).tolist() == [1, 2]


def test_empty_table(spark, vocabularies):
    docs = spark.createDataFrame([], "doc_id string, text string")
    done = op.link_scores(op.align(docs, *vocabularies))
    assert done.count() == 0 and dict(done.dtypes)["doc_id"] == "string"


def test_ids_out_of_order_are_refused(tmp_path):
    path = tmp_path / "v.json"
    path.write_text('{"model": {"vocab": {"a": 0, "b": 1, "ab": 3, "ba": 2}, "merges": ["a b", "b a"]}}')
    with pytest.raises(ValueError):
        op.load_byte_bpe(str(path))
