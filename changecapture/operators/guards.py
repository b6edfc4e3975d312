"""Checks that give the labels their meaning: unique keys, and counts per label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changecapture import columns as C
from changecapture.config import ConfigError, name_list
from changecapture.functions.encoding import quoted


class DuplicateKeys(ValueError):
    """A snapshot holds the same key more than once."""


def _resolve(df: DataFrame, names) -> list[str]:
    known = {c.lower(): c for c in df.columns}
    wanted = name_list(names)
    missing = [n for n in wanted if n not in known]
    if missing:
        raise ConfigError(f"no column {', '.join(missing)} in {df.columns}")
    return [known[n] for n in wanted]


def _copies(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.groupBy(*[F.col(quoted(n)) for n in names]).agg(F.count(F.lit(1)).alias("copies"))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their number of copies.

    Copies are counted before the shuffle, so a key that holds most of the table moves
    as one row per task.
    """
    return _copies(df, _resolve(df, keys)).where(F.col("copies") > 1)


def require_unique(df: DataFrame, keys) -> int:
    """Row count of ``df``; raises if a key occurs more than once."""
    copies = _copies(df, _resolve(df, keys))
    rows, repeated = copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)), F.count_if(F.col("copies") > 1)
    ).first()
    if repeated:
        shown = duplicate_keys(df, keys).take(3)
        raise DuplicateKeys(f"{repeated} keys occur more than once, among them {shown}")
    return rows


def dedupe(df: DataFrame, keys, order_by=()) -> DataFrame:
    """Keep the first row of every key by ``order_by``; the other columns break ties.

    The rank filter is applied inside every task before the shuffle (Spark plans a
    partial group limit), so of a hot key only one row per task is moved.
    """
    keys, order = _resolve(df, keys), _resolve(df, order_by)
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in keys and f.name not in order and _orderable(f.dataType)
    ]
    window = Window.partitionBy(*[F.col(quoted(k)) for k in keys]).orderBy(
        *[F.col(quoted(c)) for c in (*order, *rest)] or [F.lit(1)]
    )
    rank = "__rank"
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) == 1).drop(rank)


def _orderable(data_type) -> bool:
    return "map<" not in data_type.simpleString() and "variant" not in data_type.simpleString()


def action_counts(delta: DataFrame) -> DataFrame:
    """Rows per label."""
    return delta.groupBy(C.ACT).agg(F.count(F.lit(1)).alias("rows"))
