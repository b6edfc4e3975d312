"""Near-duplicate documents: Jaccard join of word n-gram sets by MinHash banding.

1. Documents of equal sets are one class; only one signature a class goes on.
2. Bands and rows follow from the threshold and the wanted recall. Classes meet in buckets of
   equal band hashes; buckets of one are dropped.
3. A bucket is dealt into blocks, and every two blocks are a group, so that no task holds a
   large bucket. A pair counts in the first band that both classes share and nowhere else.
4. Classes with such a pair fetch their full sets, and every pair is verified on these. A
   group returns the number of links of each member and one edge a member to the least one
   that it reaches within the group: links are counted, never written out.
5. Connected components of these edges are the classes of near duplicates.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changecapture.llm.common import discard, doc_key, packed, same_doc, shards, without, written
from changecapture.llm.components import connected_components

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9999
ROWS = 5
#: Classes of a bucket in a block; a task compares two blocks at a time.
BLOCK = 256
WORD = re.compile(r"\w+")
#: Words whose hashes a task remembers.
KNOWN = 100_000


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` hashes that two sets of the given similarity share one of."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


class Shingler:
    """Sorted distinct 64-bit hashes of the word n-grams of a text."""

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def _code(self, word: str) -> int:
        if len(self.known) > KNOWN:
            self.known.clear()
        code = xxhash.xxh3_64_intdigest(word)
        self.known[word] = code
        return code

    def __call__(self, text: str) -> np.ndarray:
        known, code = self.known, self._code
        found = WORD.findall(text.lower())
        codes = np.array([known.get(w) or code(w) for w in found], np.uint64)
        n = max(1, len(codes) - self.words + 1) if len(codes) else 0
        out = np.zeros(n, np.uint64)
        for i in range(min(self.words, len(codes))):
            out = (out ^ codes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
        return np.unique(out)


def _signatures(words: int, bands: int, rows: int):
    def run(batches):
        shingle = Shingler(words)
        rng = np.random.default_rng(11)
        odd = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) | np.uint64(1)
        mix = rng.integers(1, 1 << 63, rows, dtype=np.uint64) | np.uint64(1)
        for batch in batches:
            sizes, names, signs = [], [], []
            for text in batch.column("_content").to_pylist():
                grams = shingle(text)
                sizes.append(len(grams))
                names.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest())
                least = np.full(bands * rows, np.uint64(0xFFFFFFFFFFFFFFFF))
                for i in range(0, len(grams), 1024):
                    part = (grams[i : i + 1024, None] * odd) >> np.uint64(8)
                    least = np.minimum(least, part.min(axis=0))
                sign = (least.reshape(bands, rows) ^ (least.reshape(bands, rows) >> np.uint64(29))) * mix
                sign = np.bitwise_xor.reduce(sign, axis=1)
                signs.append(sign ^ (sign >> np.uint64(31)))
            if not sizes:
                continue
            pairs = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
            flat = pa.array(np.concatenate(signs).view(np.int64))
            offsets = pa.array(np.arange(len(sizes) + 1) * bands, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("_text"),
                    pa.array(pairs[:, 0]),
                    pa.array(pairs[:, 1]),
                    pa.array(sizes, pa.int32()),
                    pa.ListArray.from_arrays(offsets, flat),
                ],
                ["_id", "_text", "o1", "o2", "size", "bands"],
            )

    return run


def _sets(words: int):
    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        shingle = Shingler(words)
        for batch in batches:
            texts = (unpack.decompress(x).decode() for x in batch.column("packed").to_pylist())
            sets = [shingle(t).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("o1"), batch.column("o2"), pa.array(sets, pa.binary())],
                ["o1", "o2", "grams"],
            )

    return run


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys of a stream sorted by them, also across batches."""
    rest = None
    for batch in batches:
        here = pa.Table.from_batches([batch])
        here = here if rest is None else pa.concat_tables([rest, here])
        if not here.num_rows:
            continue
        new = np.zeros(here.num_rows, bool)
        new[0] = True
        for key in keys:
            values = here.column(key).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(new)
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            yield here.slice(a, b - a)
        rest = here.slice(starts[-1]).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest


def _fresh(group: pa.Table) -> np.ndarray:
    """Pairs (of both blocks) whose first shared band is the one of this group."""
    n = group.num_rows
    signs = np.array(group.column("bands").to_pylist(), np.int64)
    band = group.column("band")[0].as_py()
    side = group.column("side").to_numpy()
    fresh = np.ones((n, n), bool)
    for earlier in range(band):
        fresh &= signs[:, None, earlier] != signs[None, :, earlier]
    if group.column("x")[0].as_py() != group.column("y")[0].as_py():
        fresh &= side[:, None] != side[None, :]
    np.fill_diagonal(fresh, False)
    return fresh


KEYS = ["band", "bucket", "x", "y"]
MEMBER = "band int, bucket long, x int, y int, side int, o1 long, o2 long, bands array<long>"


def _needed(batches):
    """Members of a group that have a pair to verify there."""
    for group in groups(batches, KEYS):
        use = np.flatnonzero(_fresh(group).any(axis=1))
        if len(use):
            yield from group.take(pa.array(use)).combine_chunks().to_batches()


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every two sets."""
    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((n, n), np.float64)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        block = np.zeros((n, 4096), np.float32)
        block[owner[a:b], column[a:b] - start] = 1
        total += block @ block.T
    np.fill_diagonal(total, [len(s) for s in sets])
    return total.astype(np.int64)


def _verified(similarity: float):
    def run(batches):
        for group in groups(batches, KEYS):
            sets = [np.frombuffer(x, np.uint64) for x in group.column("grams").to_pylist()]
            sizes = np.array([len(s) for s in sets])
            both = overlaps(sets)
            union = sizes[:, None] + sizes[None, :] - both
            linked = _fresh(group) & (both >= similarity * union - 1e-9)
            use = np.flatnonzero(linked.any(axis=1))
            if not len(use):
                continue
            linked = linked[np.ix_(use, use)]
            least = np.arange(len(use))
            while True:  # the least member that each one reaches
                near = np.where(linked, least[None, :], len(use)).min(axis=1)
                new = np.minimum(least, near)
                new = new[new]
                if (new == least).all():
                    break
                least = new
            copies = group.column("copies").to_numpy()[use]
            o1, o2 = (group.column(c).to_numpy()[use] for c in ("o1", "o2"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (o1, o2, (linked * copies[None, :]).sum(axis=1), o1[least], o2[least])],
                ["o1", "o2", "links", "p1", "p2"],
            )

    return run


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    rows: int = ROWS,
    block: int = BLOCK,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Classes of documents linked by a Jaccard similarity of ``similarity`` or more.

    Returns ``doc_id, class_id, class_size, n_links, text_hash, first`` for each row of ``docs``:
    ``class_id`` is the least id of the class, ``n_links`` the number of other rows that are
    similar to this one, and ``first`` marks one row of each class (least id, then text).
    Words are runs of letters, digits and underscores in lower case; a text of fewer than
    ``words`` words is one n-gram. A text without words (null and empty ones too) is in a
    class of its own and has no links. Rows that repeat an id and a text are copies of each
    other, ``first`` marking them all. Null ids are ids, larger than any other as a
    ``class_id``. Other columns are ignored; an empty table gives an empty table.
    """
    bands = bands_for(similarity, recall, rows)
    count = F.count(F.lit(1))
    own = docs.select(*doc_key(id_column, text_column))
    kind = own.schema["_id"].dataType.simpleString()
    signed = written(
        own.mapInArrow(
            _signatures(words, bands, rows),
            f"_id {kind}, _text binary, o1 long, o2 long, size int, bands array<long>",
        )
    )
    full = signed.where("size > 0")
    classes = full.groupBy("o1", "o2").agg(
        count.alias("copies"),
        # ids before null ids
        F.min(F.struct(F.col("_id").isNull().alias("null"), "_id", "_text")).alias("first"),
    )
    classes = written(classes)
    signatures = full.select("o1", "o2", "bands").dropDuplicates(["o1", "o2"])
    placed = signatures.select(
        "o1", "o2", F.posexplode("bands").alias("band", "bucket")
    )
    # aggregates are written before they are joined: a crowded bucket can then be split
    crowded = written(placed.groupBy("band", "bucket").agg(count.alias("n")).where("n > 1"))
    blocks = F.ceil(F.col("n") / block).cast("int")
    members = placed.join(crowded, ["band", "bucket"]).select(
        "o1", "o2", "band", "bucket", blocks.alias("blocks"),
        F.pmod(F.xxhash64("o1", "band"), blocks).cast("int").alias("mine"),
    )
    dealt = (
        members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .join(signatures, ["o1", "o2"])
        .select(
            "band", "bucket",
            F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"),
            (F.col("mine") > F.col("other")).cast("int").alias("side"), "o1", "o2", "bands",
        )
    )
    needed = written(
        dealt.repartition(shards(docs), *KEYS).sortWithinPartitions(*KEYS).mapInArrow(_needed, MEMBER)
    )
    wanted = (
        classes.join(needed.select("o1", "o2").distinct(), ["o1", "o2"])
        .select("o1", "o2", "first._id", "first._text")
    )
    sets = written(
        same_doc(packed(own), wanted)
        .select("o1", "o2", "packed")
        .dropDuplicates(["o1", "o2"])
        .mapInArrow(_sets(words), "o1 long, o2 long, grams binary")
    )
    links = written(
        needed.join(sets, ["o1", "o2"])
        .join(classes.select("o1", "o2", "copies"), ["o1", "o2"])
        .repartition(shards(docs), *KEYS)
        .sortWithinPartitions(*KEYS)
        .mapInArrow(_verified(similarity), "o1 long, o2 long, links long, p1 long, p2 long")
    )
    discard(crowded, needed, sets)
    roots = connected_components(
        links.select(F.struct("o1", "o2").alias("u"), F.struct(F.col("p1").alias("o1"), F.col("p2").alias("o2")).alias("v"))
    ).select("node.o1", "node.o2", F.col("root.o1").alias("r1"), F.col("root.o2").alias("r2"))
    linked = links.groupBy("o1", "o2").agg(F.sum("links").alias("links")).join(roots, ["o1", "o2"])
    known = written(
        classes.join(linked, ["o1", "o2"], "left")
        .where("copies > 1 OR links IS NOT NULL")
        .select(
            "o1", "o2", "copies", "first",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("r1", "o1").alias("r1"), F.coalesce("r2", "o2").alias("r2"),
        )
    )
    named = written(known.groupBy("r1", "r2").agg(
        F.sum("copies").alias("class_size"),
        F.min("first").alias("least"),
    ))
    discard(links, classes)
    known = written(
        known.join(named, ["r1", "r2"]).select("o1", "o2", "n_links", "class_size", "least")
    )
    alone = F.col("least").isNull()
    return (
        signed.select("_id", "_text", "size", "o1", "o2")
        .join(known, ["o1", "o2"], "left")
        .select(
            F.col("_id").alias("doc_id"),
            F.when(alone, F.col("_id")).otherwise(F.col("least._id")).alias("class_id"),
            F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.col("_text").alias("text_hash"),
            (
                alone
                | (F.col("_id").eqNullSafe(F.col("least._id")) & (F.col("_text") == F.col("least._text")))
            ).alias("first"),
        )
    )


def drop_near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """``docs`` with one document of each class: least id, then text; repeated rows once."""
    classes = near_duplicates(docs, id_column=id_column, text_column=text_column, **options)
    gone = classes.where("NOT first").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text")
    )
    return without(docs, gone, id_column, text_column, once=True)
