"""Key hash and value hash of a row, as column expressions.

Columns are taken in the order of their names, so a snapshot whose columns were moved has the
same hashes. All of it is generated JVM code but for arrays and maps, whose elements Spark
encodes and sorts in interpreted expressions.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changecapture import columns as C
from changecapture.config import HASH_KINDS, ConfigError, TableConfig, name_list
from changecapture.functions.encoding import encode, quoted
from changecapture.operators.fields import FieldSets, select_fields


def digest(encoded: Column, kind: str = "md5") -> Column:
    """Hash of an encoded row as text.

    ``md5`` and ``sha`` are hex digests of 128 and 256 bits. ``murmur`` (32 bits) and
    ``xxhash`` (64 bits) are the hex form of their decimal text; they are cheaper and
    collide on large tables, so rows are then matched on the key columns too.
    """
    kind = kind.strip().lower()
    if kind == "md5":
        return F.md5(encoded)
    if kind == "sha":
        return F.sha2(encoded, 256)
    if kind == "murmur":
        return F.lower(F.hex(F.hash(encoded).cast("string")))
    if kind == "xxhash":
        return F.lower(F.hex(F.xxhash64(encoded).cast("string")))
    raise ConfigError(f"hash_kind must be one of {', '.join(HASH_KINDS)}; got {kind!r}")


def _by_name(fields) -> list:
    return sorted(fields, key=lambda f: f.name.lower())


def _sets(df: DataFrame, keys, exclusions) -> FieldSets:
    keys, exclusions = name_list(keys), name_list(exclusions)
    return FieldSets(TableConfig("t", keys, exclusions=exclusions, partition_columns=()), df.schema)


def key_hash(df: DataFrame, keys: str | Iterable[str], kind: str = "md5") -> Column:
    """Hash of the key columns of ``df``, in order of name."""
    return digest(encode(_by_name(_sets(df, keys, ()).ids)), kind)


def value_hash(
    df: DataFrame,
    keys: str | Iterable[str],
    exclusions: str | Iterable[str] | None = (),
    kind: str = "md5",
) -> Column:
    """Hash of the columns of ``df`` that are neither key nor excluded, in order of name."""
    return digest(encode(_by_name(_sets(df, keys, exclusions).valued)), kind)


def key_fields(sets: FieldSets) -> list:
    """Key columns, in order of name."""
    return _by_name(sets.ids)


def hash_columns(sets: FieldSets, cfg: TableConfig) -> tuple[Column, Column]:
    """Key hash and value hash of a table's settings.

    Value hashes have 128 bits or more whatever the kind: nothing else would tell two values
    of a key apart.
    """
    return (
        digest(encode(key_fields(sets)), cfg.hash_kind),
        digest(encode(_by_name(sets.valued)), cfg.value_hash_kind),
    )


def add_hashes(df: DataFrame, cfg: TableConfig, beside: Sequence[str] = ()) -> DataFrame:
    """Put both hashes in front of the payload (inline) or of the key columns (link).

    Columns ``beside`` the payload follow it and enter no hash.
    """
    sets = FieldSets(cfg, df.drop(*beside).schema)
    kept = sets.payload if cfg.inline else sets.ids
    taken = [f.name for f in kept if C.is_added(f.name)]
    if taken:
        raise ConfigError(f"{cfg.table}: column names the mirror needs: {', '.join(taken)}")
    key, value = hash_columns(sets, cfg)
    return df.select(
        key.alias(C.KEY_HASH),
        value.alias(C.VALUE_HASH),
        *select_fields(kept),
        *beside,
    )


def match_columns(cfg: TableConfig, df: DataFrame) -> list[str]:
    """Columns that identify a row across snapshots, as named in a hashed ``df``."""
    if not cfg.match_on_keys:
        return [C.KEY_HASH]
    return [C.KEY_HASH, *[c for c in df.columns if c.lower() in cfg.keys]]


def identity(cfg: TableConfig, df: DataFrame, prefix: str = "") -> Column:
    """Text that stands for the key of a row: its hash, or the key itself if that is short."""
    if not cfg.match_on_keys:
        return F.col(quoted(prefix + C.KEY_HASH))
    ids = _by_name(f for f in df.schema.fields if f.name.lower() in cfg.keys)
    return encode(type(f)(prefix + f.name, f.dataType, f.nullable) for f in ids)
