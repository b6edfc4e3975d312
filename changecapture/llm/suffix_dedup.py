"""Repeated byte strings by distributed prefix doubling over a sparse suffix array.

A byte is removed if a string of ``length`` bytes that covers it starts anywhere else too.

Ranking every byte would move each byte many times. Instead only *anchors* are ranked: of
all ``SEED``-byte strings inside a window of ``length`` bytes the one with the least hash
(the leftmost of equals). The anchor of a window depends on the window's bytes alone, so
equal windows have their anchor at the same offset, and about one byte in seventy is one.

Ranks are grown as in prefix doubling, and a position drops out as soon as its rank is
unique: first the seed, then the seed with its whole surroundings (all windows that may
have this anchor). Ranks are 128-bit digests, so a round counts names by hash and needs no
global sort. Equal surroundings are one class with a count: a passage in a third of all
documents is one row after the first.

Where the surroundings of a seed differ, its windows are ranked on, over ever narrower ranges
of offsets: a range whose common bytes are unique drops out, and one whose whole bytes
repeat is settled. The classes of a seed meet in one task while they are few. A seed of more
than ``TOGETHER`` classes goes through rounds that count the names of such ranges by hash.

Texts travel as compressed bytes, once to fetch the surroundings of classes that need them
and once to be cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changecapture.llm.common import discard, doc_key, packed, same_doc, shards, slices, written

LENGTH = 200
SEED = 64
#: Parts of a range of offsets that a round tells apart.
FAN = 12
BLOCK = 1 << 20
#: Classes of a seed that one task compares; and that it compares in pairs.
TOGETHER, PAIRS = 4096, 6


class Anchors:
    """Anchor positions and seed hashes of byte strings."""

    def __init__(self, length: int, seed: int, block: int = BLOCK):
        self.length, self.seed, self.block = length, seed, block
        base = np.uint64(0x9E3779B97F4A7C15)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        size = block + length
        self.power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, base))])
        self.back = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, inverse))])
        self.value = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)

    def _block(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, k = len(data), self.seed
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.value[data] * self.power[:n], out=total[1:])
        h = (total[k:] - total[:-k]) * self.back[: n - k + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        low = np.uint64(0xFFFFFFFF)
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        width, span = self.length - k + 1, 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
        at = (least & low).astype(np.int64)
        at = at[np.concatenate([[True], at[1:] != at[:-1]])]
        return at, h[at].view(np.int64)

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ascending order and the hash of the seed at each."""
        n = len(data)
        if n < self.length:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        whole, at, seeds = np.frombuffer(data, np.uint8), [], []
        for start in range(0, n - self.length + 1, self.block):
            p, h = self._block(whole[start : start + self.block + self.length - 1])
            p = p + start
            if at and len(p) and p[0] == at[-1][-1]:
                p, h = p[1:], h[1:]
            at.append(p)
            seeds.append(h)
        return np.concatenate(at), np.concatenate(seeds)


def digest(content: bytes, lo: int, hi: int) -> bytes:
    return hashlib.blake2b(b"%d,%d," % (lo, hi) + content, digest_size=16).digest()


def halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128-bit names as two columns of longs."""
    pairs = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _batch(columns: dict[str, tuple]) -> pa.RecordBatch:
    """``name: (values, Arrow type)``"""
    arrays = [pa.array(values, kind) for values, kind in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def _seeds(length: int, seed: int):
    def run(batches):
        anchors = Anchors(length, seed)
        for batch in slices(batches):
            found = [anchors.of(x)[1] for x in batch.column("_bytes").to_pylist()]
            if found:
                yield _batch({"seed": (np.concatenate(found), "int64")})

    return run


def _surroundings(length: int, seed: int):
    """Anchors with the name of all windows that may have them."""
    widest = length - seed

    def run(batches):
        anchors = Anchors(length, seed)
        for batch in slices(batches):
            rows, ats, seeds, names, least, most = [], [], [], [], [], []
            for row, data in enumerate(batch.column("_bytes").to_pylist()):
                at, h = anchors.of(data)
                # offsets of the anchor in windows that lie inside the text
                d_hi = np.minimum(at, widest)
                d_lo = np.maximum(at + length - len(data), 0)
                names += [
                    digest(data[a - hi : a - lo + length], lo, hi)
                    for a, lo, hi in zip(at.tolist(), d_lo.tolist(), d_hi.tolist(), strict=True)
                ]
                rows.append(np.full(len(at), row))
                ats.append(at)
                seeds.append(h)
                least.append(d_lo)
                most.append(d_hi)
            if names:
                o1, o2 = halves(names)
                at_row = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").take(at_row),
                        batch.column("_text").take(at_row),
                        pa.array(np.concatenate(ats)),
                        pa.array(np.concatenate(seeds)),
                        pa.array(o1),
                        pa.array(o2),
                        pa.array(np.concatenate(least).astype(np.int32)),
                        pa.array(np.concatenate(most).astype(np.int32)),
                    ],
                    ["_id", "_text", "at", "seed", "o1", "o2", "d_lo", "d_hi"],
                )

    return run


CLASS = ("seed", "classes", "n", "o1", "o2", "d_lo", "d_hi")


def _contents(length: int):
    """Bytes around the representatives of classes."""

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        last = None
        for batch in slices(batches):
            out = []
            packed = batch.column("packed")
            for row, wanted in enumerate(batch.column("wanted").to_pylist()):
                # copies of a row mostly follow each other, and one of them is enough
                if wanted[0] == last:
                    continue
                last = dict(wanted[0])
                data = unpack.decompress(packed[row].as_py())
                for w in wanted:
                    w["content"] = data[w["at"] - w["d_hi"] : w["at"] - w["d_lo"] + length]
                out += wanted
            if out:
                kinds = dict.fromkeys(CLASS, "int64") | {"d_lo": "int32", "d_hi": "int32", "content": "binary"}
                yield _batch({name: ([w[name] for w in out], kind) for name, kind in kinds.items()})

    return run


def equal_windows(one: dict, two: dict, length: int) -> tuple[int, int]:
    """Offsets (first, last) of the windows that two surroundings share; first > last if none."""
    a, b = one["d_hi"], two["d_hi"]
    left = min(a, b)
    x = int.from_bytes(one["content"][a - left : a], "little") if left else 0
    y = int.from_bytes(two["content"][b - left : b], "little") if left else 0
    # matching bytes before the anchor, from the anchor back: the highest bytes
    left -= ((x ^ y).bit_length() + 7) // 8
    ahead_one, ahead_two = one["content"][a:], two["content"][b:]
    right = min(len(ahead_one), len(ahead_two))
    x = int.from_bytes(ahead_one[:right], "big")
    y = int.from_bytes(ahead_two[:right], "big")
    right -= ((x ^ y).bit_length() + 7) // 8
    first = max(one["d_lo"], two["d_lo"], length - right)
    return first, min(a, b, left)


def shared_windows(classes: list[dict], length: int) -> Iterator[tuple[dict, int, int]]:
    """Ranges of offsets whose windows several classes have, by halving ranges of offsets."""

    def groups(members, key) -> list[list]:
        found: dict = {}
        for c in members:
            found.setdefault(key(c), []).append(c)
        return [g for g in found.values() if len(g) > 1]

    def whole(c, lo: int, hi: int) -> tuple:
        lo, hi = max(lo, c["d_lo"]), min(hi, c["d_hi"])
        return lo, hi, c["content"][c["d_hi"] - hi : c["d_hi"] - lo + length]

    todo = [(0, max(c["d_hi"] for c in classes), classes)]
    while todo:
        lo, hi, members = todo.pop()
        rest = {id(c): c for c in members}
        for same in groups(members, lambda c: whole(c, lo, hi)):
            for c in same:
                yield c, *whole(c, lo, hi)[:2]
            for c in same[1:]:  # one of them stands for all from here on
                del rest[id(c)]
        if lo == hi or len(rest) < 2:
            continue
        middle = (lo + hi) // 2
        for a, b in ((lo, middle), (middle + 1, hi)):
            here = [c for c in rest.values() if c["d_lo"] <= b and c["d_hi"] >= a]
            # the bytes that all windows of the range have in common
            todo += [
                (a, b, same)
                for same in groups(here, lambda c: c["content"][c["d_hi"] - a : c["d_hi"] - b + length])
            ]


def _compared(length: int):
    """Ranges of offsets whose windows another class of the same seed has too."""

    def solve(group: list[dict], out: list) -> None:
        classes = list({(c["o1"], c["o2"]): c for c in group}.values())
        if len(classes) > PAIRS:
            for c, first, last in shared_windows(classes, length):
                out.append((c["o1"], c["o2"], first, last))
            return
        for i, one in enumerate(classes):
            for two in classes[:i]:
                first, last = equal_windows(one, two, length)
                if first <= last:
                    out += [(c["o1"], c["o2"], first, last) for c in (one, two)]

    def run(batches):
        group: list[dict] = []
        for batch in slices(batches):
            out: list = []
            for row in batch.to_pylist():
                if group and group[0]["seed"] != row["seed"]:
                    solve(group, out)
                    group = []
                group.append(row)
            if out:
                yield _ranges(out)
        out = []
        solve(group, out)
        if out:
            yield _ranges(out)

    return run


def _ranges(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"o1": "int64", "o2": "int64", "d_lo": "int32", "d_hi": "int32"}
    return _batch(dict(zip(kinds, zip(zip(*rows, strict=True), kinds.values(), strict=True), strict=True)))


def parts(lo: int, hi: int, fan: int = FAN) -> list[tuple[int, int]]:
    step = -(-(hi - lo + 1) // fan)
    return [(a, min(a + step - 1, hi)) for a in range(lo, hi + 1, step)]


def _names(length: int):
    """Each pending range of offsets in parts: names of all windows and of their common bytes."""

    def run(batches):
        for batch in slices(batches):
            meta, outer, inner = [], [], []
            for x in batch.to_pylist():
                content, d_lo, d_hi = x["content"], x["d_lo"], x["d_hi"]
                for p in x["pending"]:
                    for lo, hi in parts(p["lo"], p["hi"]):
                        e_lo, e_hi = max(lo, d_lo), min(hi, d_hi)
                        if e_lo > e_hi:
                            continue
                        outer.append(digest(content[d_hi - e_hi : d_hi - e_lo + length], e_lo, e_hi))
                        inner.append(digest(content[d_hi - lo : d_hi - hi + length], lo, hi))
                        meta.append((x["o1"], x["o2"], p["weight"], lo, hi, e_lo, e_hi))
            if meta:
                names = ("o1", "o2", "weight", "lo", "hi", "e_lo", "e_hi", "n1", "n2", "m1", "m2")
                kinds = ("int64",) * 3 + ("int32",) * 4 + ("int64",) * 4
                values = (*zip(*meta, strict=True), *halves(outer), *halves(inner))
                yield _batch(dict(zip(names, zip(values, kinds, strict=True), strict=True)))

    return run


def cut(data: bytes, lo: list[int], hi: list[int]) -> tuple[int, int, bytes]:
    """Bytes removed, maximal runs removed, and what is left, for spans ``[lo, hi)``."""
    if not lo:
        return 0, 0, data
    order = np.argsort(lo, kind="stable")
    lo, hi = np.asarray(lo)[order], np.maximum.accumulate(np.asarray(hi)[order])
    new = np.concatenate([[True], lo[1:] > hi[:-1]])
    starts = lo[new]
    ends = hi[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(hi) - 1]])]
    edges = [0, *np.column_stack([starts, ends]).ravel().tolist(), len(data)]
    left = b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
    return int((ends - starts).sum()), len(starts), left


def _cut(batches):
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    for batch in slices(batches):
        sizes, removed, spans, left = [], [], [], []
        packed, cuts = batch.column("packed"), batch.column("spans").to_pylist()
        for row, found in enumerate(cuts):
            data = unpack.decompress(packed[row].as_py())
            n, k, rest = cut(data, [s["lo"] for s in found or ()], [s["hi"] for s in found or ()])
            sizes.append(len(data))
            removed.append(n)
            spans.append(k)
            left.append(rest)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_id"),
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.int64()),
                pa.array(left, pa.binary()),
            ],
            ["_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def _rounds(contents: DataFrame, length: int, seed: int) -> list[DataFrame]:
    """Windows that several classes of a seed share, for any number of classes."""
    covered, count = [], F.count(F.lit(1))
    contents = written(contents.select("o1", "o2", "n", "d_lo", "d_hi", "content"))
    pending = contents.select(
        "o1", "o2", F.col("n").alias("weight"), F.lit(0).alias("lo"), F.lit(length - seed).alias("hi")
    )
    size = length - seed + 1
    while True:
        size = -(-size // FAN)
        grouped = pending.groupBy("o1", "o2").agg(
            F.collect_list(F.struct("lo", "hi", "weight")).alias("pending")
        )
        named = written(
            contents.join(grouped, ["o1", "o2"]).mapInArrow(
                _names(length),
                "o1 long, o2 long, weight long, lo int, hi int, e_lo int, e_hi int, "
                "n1 long, n2 long, m1 long, m2 long",
            )
        )
        outer = written(
            named.groupBy("m1", "m2", "n1", "n2").agg(
                F.sum("weight").alias("weight"),
                F.min(F.struct("o1", "o2")).alias("first"),
                F.min("lo").alias("lo"),
                F.min("hi").alias("hi"),
            )
        )
        twice = outer.where("weight > 1").select("n1", "n2")
        covered.append(
            named.join(twice, ["n1", "n2"], "left_semi").select(
                "o1", "o2", F.col("e_lo").alias("d_lo"), F.col("e_hi").alias("d_hi")
            )
        )
        if size == 1:
            return covered
        several = written(
            outer.groupBy("m1", "m2").agg(count.alias("m")).where("m > 1").select("m1", "m2")
        )
        pending = (
            outer.where("hi > lo")
            .join(several, ["m1", "m2"], "left_semi")
            .select("first.o1", "first.o2", "weight", "lo", "hi")
        )


def repeated_spans(
    own: DataFrame, kind: str, length: int = LENGTH, seed: int = SEED, together: int = TOGETHER
) -> DataFrame:
    """Spans of repeated strings: ``_id, _text, lo, hi``. ``own``: columns of ``doc_key``."""
    docs = own.select("_id", "_text", F.col("_content").cast("binary").alias("_bytes"))
    count = F.count(F.lit(1))
    # aggregates are written before they are joined: a very frequent name can then be split
    often = written(
        docs.mapInArrow(_seeds(length, seed), "seed long")
        .groupBy("seed")
        .agg(count.alias("n"))
        .where("n > 1")
        .select("seed")
    )
    anchors = docs.mapInArrow(
        _surroundings(length, seed),
        f"_id {kind}, _text binary, at long, seed long, o1 long, o2 long, d_lo int, d_hi int",
    )
    anchors = written(anchors.join(often, "seed", "left_semi"))
    discard(often)
    classes = written(
        anchors.groupBy("seed", "o1", "o2", "d_lo", "d_hi").agg(
            count.alias("n"), F.min(F.struct("_id", "_text", "at")).alias("first")
        )
    )
    # seeds with more than one surrounding: their windows have to be told apart
    several = written(
        classes.groupBy("seed").agg(count.alias("classes")).where("classes > 1")
    )
    wanted = (
        classes.join(several, "seed")
        .groupBy("first._id", "first._text")
        .agg(F.collect_list(F.struct(*CLASS, "first.at")).alias("wanted"))
    )
    contents = written(
        same_doc(packed(own), wanted)
        .select("packed", "wanted")
        .mapInArrow(
            _contents(length),
            "seed long, classes long, n long, o1 long, o2 long, d_lo int, d_hi int, content binary",
        )
    )
    span = "o1 long, o2 long, d_lo int, d_hi int"
    few = (
        contents.where(F.col("classes") <= together)
        .repartition(shards(docs), "seed")
        # a document that occurs many times gives its surroundings many times
        .distinct()
        .sortWithinPartitions("seed")
        .mapInArrow(_compared(length), span)
    )
    many = contents.where(F.col("classes") > together).dropDuplicates(["o1", "o2"])
    covered = [classes.where("n > 1").select("o1", "o2", "d_lo", "d_hi"), few]
    if not many.isEmpty():
        covered += _rounds(many, length, seed)
    ranges = covered[0]
    for more in covered[1:]:
        ranges = ranges.unionByName(more)
    ranges = written(ranges)
    discard(classes, several, contents)
    return (
        anchors.select("_id", "_text", "at", "o1", "o2")
        .join(ranges, ["o1", "o2"])
        .select(
            "_id",
            "_text",
            (F.col("at") - F.col("d_hi")).alias("lo"),
            (F.col("at") - F.col("d_lo") + length).alias("hi"),
        )
    )


def drop_repeated_bytes(
    docs: DataFrame,
    length: int = LENGTH,
    seed: int = SEED,
    together: int = TOGETHER,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts anywhere else.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes), one row per
    row of ``docs``. Matches never cross documents; overlapping repetitions count, and all
    is judged on the input. Null texts are empty. Rows that repeat an id and a text are
    copies of each other, and so are removed from ``length`` bytes on. Null ids are ids.
    Other columns are ignored. An empty table gives an empty table.
    """
    if not 0 < seed <= length:
        raise ValueError("seed must lie between 1 and length")
    own = docs.select(*doc_key(id_column, text_column))
    kind = own.schema["_id"].dataType.simpleString()
    spans = (
        repeated_spans(own, kind, length, seed, together)
        .groupBy("_id", "_text")
        .agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    )
    done = same_doc(packed(own), spans, "left").mapInArrow(
        _cut, f"_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    )
    return done.withColumnRenamed("_id", "doc_id")
