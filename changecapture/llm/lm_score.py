"""Stupid-backoff language model scores, computed as joins of hashed n-gram tables.

Every document is scored under the counts of all other documents: its own occurrences are
taken out, so a text is as likely as the rest of the corpus makes it.

N-grams are 64-bit hashes. Rows of single n-grams would cost several times their content to
shuffle, so a row holds one block of documents and one hash range: the sorted distinct
n-grams of the block in that range, and their counts.

1. Documents go to blocks by hash; the number of blocks follows the number of documents.
2. Each block explodes its texts to n-grams of orders 1 to ``order``, pre-aggregates them and
   deals them to hash partitions; the number of partitions follows the number of words.
3. Each partition adds up its count table and answers every block with the corpus counts of
   the n-grams that the block asked for. A word in a third of all documents is one number
   in the row of each block.
4. Each block joins the answers to its exploded n-grams and sums the scores by document.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changecapture.llm.common import doc_key, packed, written

ORDER = 3
BACKOFF = 0.4
#: Documents in a block, and distinct n-grams of blocks in a partition (expected numbers).
BLOCK_DOCS = 2048
PARTITION_GRAMS = 4_000_000
WORD = re.compile(r"\w+")


class Words:
    """64-bit codes of the words of a text, in lower case."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def _code(self, word: str) -> int:
        if len(self.known) > 100_000:
            self.known.clear()
        code = xxhash.xxh3_64_intdigest(word)
        self.known[word] = code
        return code

    def __call__(self, text: str) -> np.ndarray:
        known, code = self.known, self._code
        return np.array([known.get(w) or code(w) for w in WORD.findall(text.lower())], np.uint64)


def grams(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the 1- to ``order``-grams that start at each word; the last ones are shorter."""
    out, h = [], np.zeros(len(codes), np.uint64)
    for n in range(order):
        if len(codes) <= n:
            out.append(np.empty(0, np.uint64))
            continue
        h = (h[: len(codes) - n] ^ codes[n:]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n + 1)
        h ^= h >> np.uint64(32)
        out.append(h)
    return out


def stupid_backoff(
    counts: list[np.ndarray], total: float, backoff: float = BACKOFF
) -> np.ndarray:
    """Log score of each word from the counts of the n-grams that start at each word.

    ``counts[n - 1][i]`` belongs to the n-gram of words i to i+n-1. The score of a word is the
    relative frequency after the longest context that was seen with it, times ``backoff``
    for every word of context given up. A word never seen scores as if seen half a time.
    """
    size, order = len(counts[0]), len(counts)
    score = np.log(np.where(counts[0] > 0, counts[0], 0.5) / max(total, 1.0))
    for n in range(2, order + 1):
        at = np.arange(n - 1, size)  # words with n-1 words before them
        if not len(at):
            break
        whole, context = counts[n - 1][: len(at)], counts[n - 2][: len(at)]
        seen = (whole > 0) & (context > 0)
        longer = np.log(np.where(seen, whole, 1.0) / np.where(seen, context, 1.0))
        score[at] = np.where(seen, longer, score[at] + np.log(backoff))
    return score


def _packed_counts(hashes: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    import zstandard

    pack = zstandard.ZstdCompressor(level=1)
    steps = np.diff(hashes, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)
    return pack.compress(steps.T.tobytes()), pack.compress(counts.astype(np.int64).tobytes())


def _hashes(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _counts(data: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.int64)


def _texts(values) -> list[str]:
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(x).decode() for x in values]


def _edges(partitions: int) -> np.ndarray:
    """Lower bounds of equal ranges of the 64-bit hashes."""
    return np.array([(i << 64) // partitions for i in range(partitions)], np.uint64)


def _sorted(by_doc: list[list[np.ndarray]], n: int) -> tuple[np.ndarray, ...]:
    """All n-grams of a block by hash, then document: hashes, their order, and where a new
    n-gram and a new pair of n-gram and document begin."""
    hashes = np.concatenate([g[n] for g in by_doc])
    doc = np.repeat(np.arange(len(by_doc)), [len(g[n]) for g in by_doc])
    order = np.argsort(hashes, kind="stable")
    hashes, doc = hashes[order], doc[order]
    gram = np.ones(len(hashes), bool)
    gram[1:] = hashes[1:] != hashes[:-1]
    pair = gram.copy()
    pair[1:] |= doc[1:] != doc[:-1]
    return hashes, order, gram, pair


def _runs(new: np.ndarray) -> np.ndarray:
    """Lengths of the runs that begin where ``new`` is true."""
    return np.diff(np.append(np.flatnonzero(new), len(new)))


def _asked(order: int, partitions: int):
    """A block's distinct n-grams by order and hash range, with the block's counts."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        words, edges, out = Words(), _edges(partitions), []
        by_doc = [grams(words(t), order) for t in _texts(block["packed"])]
        key = block["block"].iloc[0]
        for n in range(order):
            hashes, _, gram, _ = _sorted(by_doc, n)
            hashes, counts = hashes[gram], _runs(gram)
            cuts = np.append(np.searchsorted(hashes, edges), len(hashes))
            for p in np.flatnonzero(np.diff(cuts)):
                a, b = cuts[p], cuts[p + 1]
                out.append((key, n + 1, int(p), *_packed_counts(hashes[a:b], counts[a:b])))
        return pd.DataFrame(out, columns=["block", "order", "part", "hashes", "counts"])

    return run


def _answered(rows: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts for every block that asked, in its order of n-grams."""
    hashes = [_hashes(x) for x in rows["hashes"]]
    counts = [_counts(x) for x in rows["counts"]]
    known, where = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(where, np.concatenate(counts), len(known)).astype(np.int64)
    import zstandard

    pack = zstandard.ZstdCompressor(level=1)
    ends = np.cumsum([len(h) for h in hashes])
    answers = [pack.compress(total[w].tobytes()) for w in np.split(where, ends[:-1])]
    own = [int(c.sum()) for c in counts]
    return rows[["block", "order", "part"]].assign(own=own, totals=answers)


def _scored(order: int, backoff: float, size: int):
    def run(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        words, rest = Words(), []
        by_doc = [grams(words(t), order) for t in _texts(block["packed"])]
        answers = answers.sort_values(["order", "part"])
        for n in range(order):
            found = [_counts(x) for x in answers.loc[answers["order"] == n + 1, "totals"]]
            totals = np.concatenate([*found, np.empty(0, np.int64)])
            _, at, gram, pair = _sorted(by_doc, n)
            others = np.empty(len(at))
            others[at] = np.repeat(totals, _runs(gram)) - np.repeat(_runs(pair), _runs(pair))
            rest.append(np.split(others, np.cumsum([len(g[n]) for g in by_doc])[:-1]))
        out = []
        for i, doc in enumerate(by_doc):
            logs = stupid_backoff([r[i] for r in rest], size - len(doc[0]), backoff)
            out.append((len(logs), float(logs.sum())))
        frame = block[["_id", "_text"]].copy()
        frame["n_words"] = [n for n, _ in out]
        frame["log_score"] = [s for _, s in out]
        return frame

    return run


def score(
    docs: DataFrame,
    order: int = ORDER,
    backoff: float = BACKOFF,
    block_docs: int = BLOCK_DOCS,
    partition_grams: int = PARTITION_GRAMS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Stupid-backoff score of each document under the counts of all others.

    Returns ``doc_id, n_words, log_score, per_word`` (natural logarithms), one row per row of
    ``docs``. Words are runs of letters, digits and underscores, or single marks, in lower
    case. A text without words (null and empty ones too) has 0 words, ``log_score`` 0 and no
    ``per_word``. Rows that repeat are documents of their own and count for each other. Other
    columns are ignored; an empty table gives an empty table.
    """
    # the text's hash only helps to deal rows to blocks: 32 bits are enough
    own = docs.select(*doc_key(id_column, text_column)).withColumn("_text", F.hash("_content"))
    kind = own.schema["_id"].dataType.simpleString()
    # about six characters a word, and at most as many distinct n-grams of an order as words
    sizes = own.agg(F.count(F.lit(1)).alias("docs"), F.sum(F.length("_content")).alias("chars")).first()
    blocks = max(1, -(-sizes["docs"] // block_docs))
    partitions = max(1, -(-order * (sizes["chars"] or 0) // 6 // partition_grams))
    dealt = packed(own).select(
        F.to_json(F.struct(F.col("_id").alias("id"))).alias("_id"),
        "_text",
        "packed",
        F.pmod(F.xxhash64("_id", "_text"), F.lit(blocks)).cast("int").alias("block"),
    )
    answers = written(
        dealt.groupBy("block")
        .applyInPandas(
            _asked(order, partitions),
            "block int, order int, part int, hashes binary, counts binary",
        )
        .groupBy("order", "part")
        .applyInPandas(_answered, "block int, order int, part int, own long, totals binary")
    )
    size = answers.where("order = 1").agg(F.sum("own")).first()[0] or 0
    done = (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInPandas(_scored(order, backoff, size), "_id string, _text int, n_words long, log_score double")
    )
    return done.select(
        F.from_json("_id", f"id {kind}")["id"].alias("doc_id"),
        "n_words",
        "log_score",
        F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).alias("per_word"),
    )
