"""Match a snapshot whose repeated keys are dropped with the mirror, by the key columns.

Hashes and surrogate keys are texts that no codec makes smaller, and most of what a row of a
narrow table weighs. Here rows are shuffled by their key columns and without what follows from
their other columns: it is computed after the shuffle. Of the mirror's own hashes and keys only
those are moved that do not follow from the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changecapture import columns as C
from changecapture.config import TableConfig
from changecapture.functions.encoding import quoted
from changecapture.functions.hashing import add_hashes, hash_columns, identity, key_fields
from changecapture.operators.classify import (
    NEW,
    OLD,
    _new,
    _old,
    _prefixed,
    _sides,
    _stamped,
    assign_nk,
    label,
)
from changecapture.operators.fields import FieldSets, select_fields
from changecapture.operators.guards import _orderable, _resolve

#: A key column, null as a default; which key columns are null; the place of a row in its key.
KEY, NULLS, RANK = "__key_{}", "__key_nulls", "__rank"

# types whose values Spark groups just as their canonical texts do, and a value for null
DEFAULTS = {
    T.ByteType(): 0,
    T.ShortType(): 0,
    T.IntegerType(): 0,
    T.LongType(): 0,
    T.BooleanType(): False,
    T.StringType(): "",
    T.DateType(): "1970-01-01",
    T.TimestampType(): "1970-01-01",
    T.TimestampNTZType(): "1970-01-01",
}


def applies(cfg: TableConfig, schema: T.StructType) -> bool:
    """Whether rows can be matched by their key columns as they stand."""
    sets = FieldSets(cfg, schema)
    own = {NULLS, RANK, *(KEY.format(i) for i in range(len(sets.ids)))}
    return (
        cfg.on_duplicates == "keep_first"
        and bool(cfg.dedupe_order)
        and not cfg.buckets
        and not cfg.keys_first
        and 0 < len(sets.ids) < 63
        and all(f.dataType in DEFAULTS or isinstance(f.dataType, T.DecimalType) for f in sets.ids)
        and not any(f.name.lower() in own or C.is_added(f.name) for f in sets.payload)
        and not {n.lower() for n in C.ADDED} & set(cfg.dedupe_order)
    )


def places(cfg: TableConfig) -> list[str]:
    """Columns that rows are shuffled and matched by."""
    return [*(KEY.format(i) for i in range(len(cfg.keys))), NULLS]


def _places(ids: list[T.StructField]) -> list[Column]:
    nulls, shown = F.lit(0).cast("long"), []
    for i, f in enumerate(ids):
        default = F.lit(DEFAULTS.get(f.dataType, 0)).cast(f.dataType)
        shown.append(F.coalesce(F.col(quoted(f.name)), default).alias(KEY.format(i)))
        null = F.when(F.col(quoted(f.name)).isNull(), F.lit(1 << i).cast("long"))
        nulls = nulls + F.coalesce(null, F.lit(0).cast("long"))
    return [*shown, nulls.alias(NULLS)]


def _payload(sets: FieldSets, ids: list[T.StructField]) -> list[Column]:
    """The payload of rows that were placed, with their key columns."""
    keys = {
        f.name: F.when(F.col(NULLS).bitwiseAND(1 << i) == 0, F.col(KEY.format(i))).alias(f.name)
        for i, f in enumerate(ids)
    }
    return [keys.get(f.name, F.col(quoted(f.name))) for f in sets.payload]


def kept_first(source: DataFrame, cfg: TableConfig) -> DataFrame:
    """A hashed snapshot without repeated keys, and its ``places``.

    The same rows stay as ``dedupe`` keeps of a hashed snapshot: the first by ``dedupe_order``,
    value hash and the other columns. Before the shuffle each task drops the rows of a key that
    are not first by ``dedupe_order``; value hashes choose among those that are, after it.
    """
    sets = FieldSets(cfg, source.schema)
    ids = key_fields(sets)
    keys = {f.name for f in ids}
    order = [c for c in _resolve(source, cfg.dedupe_order) if c not in keys]
    rest = [
        f.name
        for f in sets.payload
        if f.name not in keys and f.name not in order and _orderable(f.dataType)
    ]
    placed = source.select(
        *_places(ids), *select_fields(f for f in sets.payload if f.name not in keys)
    )
    copies = Window.partitionBy(*places(cfg))
    by = [F.col(quoted(c)) for c in order] or [F.lit(1)]
    ahead = placed.withColumn(RANK, F.rank().over(copies.orderBy(*by))).where(F.col(RANK) == 1)
    hashed = add_hashes(ahead.select(*places(cfg), *_payload(sets, ids)), cfg, places(cfg))
    ties = copies.orderBy(*by, *[F.col(quoted(c)) for c in (C.VALUE_HASH, *rest)])
    first = hashed.withColumn(RANK, F.row_number().over(ties)).where(F.col(RANK) + 0 == 1)
    return first.drop(RANK)


def _moved(new: DataFrame, mirror: DataFrame, cfg: TableConfig) -> DataFrame:
    """The mirror dealt out by its keys."""
    source = new.drop(*C.HASHES, *places(cfg))
    sets = FieldSets(cfg, source.schema)
    ids = key_fields(sets)
    keys = {f.name for f in ids}
    key, value = hash_columns(sets, cfg)
    rows = mirror.select(
        *[F.col(c).alias(c) for c in (C.JOB, *C.HASHES)],
        *[F.col(quoted(f.name)).alias(f.name) for f in sets.payload],
        *[F.col(C.NK).alias(C.NK) for _ in range(cfg.table_type == "dim")],
    )
    follows = {C.KEY_HASH: lambda df: key, C.VALUE_HASH: lambda df: value}
    if cfg.table_type == "dim":
        follows[C.NK] = lambda df: assign_nk(cfg, identity(cfg, df), F.col(C.JOB))
    slim = rows.select(
        *_places(ids),
        C.JOB,
        *select_fields(f for f in sets.payload if f.name not in keys),
        *[F.when(~F.col(c).eqNullSafe(made(rows)), F.col(c)).alias(c) for c, made in follows.items()],
    )
    moved = slim.repartition(*places(cfg))
    out = moved.select(*places(cfg), C.JOB, *follows, *_payload(sets, ids))
    for c, made in follows.items():
        out = out.withColumn(c, F.coalesce(F.col(c), made(out)))
    return out


def classify_kept(new: DataFrame, mirror: DataFrame, cfg: TableConfig) -> DataFrame:
    """The rows of ``classify`` for a snapshot of ``kept_first``."""
    at = places(cfg)
    plain = new.drop(*at)
    new_rows, old_rows = _sides(plain, mirror, cfg)
    old = _moved(new, mirror, cfg).select(*at, *[F.col(quoted(c)) for c in old_rows.columns])
    # no equality: the key columns alone say where rows meet
    on = (_new(C.KEY_HASH) <= _old(C.KEY_HASH)) & (_new(C.KEY_HASH) >= _old(C.KEY_HASH))
    for name in at:
        on = on & (_new(name) == _old(name))
    pairs = _prefixed(new, NEW).join(_prefixed(old, OLD), on, "full_outer")
    return _stamped(pairs.withColumn(C.ACT, label()), new_rows, old_rows, cfg)
