"""Digests of buckets of rows: two sides are compared without moving their rows.

Rows fall into buckets by their key hash. The digest of a bucket is the number of its rows and
the sum of what their hashes come to, in 120 bits: it does not depend on the order of the rows,
and it can be carried forward by what was added and taken away. Only buckets whose digests differ
hold changed rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changecapture import columns as C

BUCKET = "__bucket"
_SUMS = ("n", "high", "low")


def bucket(key_hash: Column, buckets: int) -> Column:
    """Bucket of a row, from the first 32 bits of its key hash."""
    return F.conv(F.substring(key_hash, 1, 8), 16, 10).cast("long") % buckets


def _part(mixed: Column, start: int) -> Column:
    return F.conv(F.substring(mixed, start, 15), 16, 10).cast("decimal(19, 0)")


def digests(
    rows: DataFrame,
    buckets: int,
    key: str = C.KEY_HASH,
    value: str = C.VALUE_HASH,
    sign: Column | None = None,
) -> DataFrame:
    """``__bucket, n, high, low`` of hashed rows; ``sign`` -1 takes a row away."""
    mixed = F.md5(F.concat(F.col(key), F.lit(":"), F.col(value)))
    sign = F.lit(1) if sign is None else sign
    one = {"n": F.lit(1).cast("decimal(19, 0)"), "high": _part(mixed, 1), "low": _part(mixed, 16)}
    kind = "decimal(38, 0)"
    return (
        rows.select(
            bucket(F.col(key), buckets).alias(BUCKET),
            *[(one[c] * sign).cast("decimal(20, 0)").alias(c) for c in _SUMS],
        )
        .groupBy(BUCKET)
        .agg(*[F.sum(c).cast(kind).alias(c) for c in _SUMS])
    )


def carried_forward(before: DataFrame, *changes: DataFrame) -> DataFrame:
    """Digests after the rows behind ``changes`` came (and, with a sign, went)."""
    for own in changes:
        before = before.unionByName(own)
    kind = "decimal(38, 0)"
    sums = before.groupBy(BUCKET).agg(*[F.sum(c).cast(kind).alias(c) for c in _SUMS])
    return sums.where("n <> 0")


def differing(new: DataFrame, old: DataFrame) -> DataFrame:
    """Buckets whose digests differ, or that one side lacks."""
    there = old.withColumnsRenamed({c: f"_{c}" for c in (BUCKET, *_SUMS)})
    pairs = new.join(there, F.col(BUCKET) == F.col(f"_{BUCKET}"), "full_outer")
    same = F.lit(True)
    for c in _SUMS:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return pairs.where(~same).select(F.coalesce(BUCKET, f"_{BUCKET}").alias(BUCKET))


def among(rows: DataFrame, found: DataFrame, buckets: int) -> DataFrame:
    """Rows of the given buckets, of which there are 65,536 at most: see ``TableConfig``."""
    own = bucket(F.col(C.KEY_HASH), buckets)
    return rows.join(F.broadcast(found), own == F.col(BUCKET), "left_semi")
