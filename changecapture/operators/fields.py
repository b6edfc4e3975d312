"""Named subsets of a table's columns, derived from its settings and schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changecapture import columns as C
from changecapture.config import ConfigError, TableConfig
from changecapture.functions.encoding import quoted


def select_fields(fields: Iterable[T.StructField]) -> list[Column]:
    return [F.col(quoted(f.name)) for f in fields]


class FieldSets:
    """Column sets of a source schema. Names compare without case; order is the schema's."""

    def __init__(self, cfg: TableConfig, schema: T.StructType):
        self.cfg = cfg
        self.payload = list(schema.fields)
        names = [f.name.lower() for f in self.payload]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ConfigError(f"{cfg.table}: column names differ only in case: {', '.join(twice)}")
        missing = [k for k in cfg.keys if k not in names]
        if missing:
            raise ConfigError(f"{cfg.table}: no key column {', '.join(missing)} in {names}")

    def _among(self, names) -> list[T.StructField]:
        return [f for f in self.payload if f.name.lower() in names]

    def _beside(self, fields) -> list[T.StructField]:
        names = {f.name for f in fields}
        return [f for f in self.payload if f.name not in names]

    @property
    def meta(self) -> list[T.StructField]:
        """Lineage columns of the table type."""
        return [C.added_field(n) for n in C.lineage(self.cfg.table_type)]

    @property
    def kv_hash(self) -> list[T.StructField]:
        return [C.added_field(n) for n in C.HASHES]

    @property
    def ids(self) -> list[T.StructField]:
        """Key columns."""
        return self._among(self.cfg.keys)

    @property
    def s_part_keys(self) -> list[T.StructField]:
        """Partition columns of the source."""
        return self._among(self.cfg.partition_columns)

    @property
    def hash_ex(self) -> list[T.StructField]:
        """Columns no hash covers: lineage, exclusions, and where the row was landed."""
        out = {n.lower() for n in C.ADDED} | set(self.cfg.exclusions)
        out |= set(self.cfg.partition_columns)
        return self._among(out - set(self.cfg.keys))

    @property
    def payload_bare(self) -> list[T.StructField]:
        """Payload less the key columns."""
        return self._beside(self.ids)

    @property
    def payload_hashex(self) -> list[T.StructField]:
        """Payload less the columns no hash covers."""
        return self._beside(self.hash_ex)

    @property
    def payload_metaex(self) -> list[T.StructField]:
        """Payload less lineage columns."""
        return [f for f in self.payload if not C.is_added(f.name)]

    @property
    def valued(self) -> list[T.StructField]:
        """Columns the value hash covers."""
        keys = set(self.cfg.keys)
        return [f for f in self.payload_hashex if f.name.lower() not in keys]

    @property
    def meta_table(self) -> list[T.StructField]:
        """Columns of the delta; the mirror has the same less the label."""
        if self.cfg.inline:
            return self.meta + self.kv_hash + self.payload
        return self.meta + self.kv_hash + self.ids + self.link_part_keys

    @property
    def link_part_keys(self) -> list[T.StructField]:
        """Source partition columns a link table stores, typed as in the source if known."""
        known = {f.name.lower(): f for f in self.s_part_keys}
        keys = set(self.cfg.keys)
        return [
            known.get(n, T.StructField(n, T.StringType(), True))
            for n in self.cfg.partition_columns
            if n not in keys
        ]


SET_NAMES = (
    "ids",
    "s_part_keys",
    "hash_ex",
    "payload",
    "payload_bare",
    "payload_hashex",
    "payload_metaex",
)


def project(df: DataFrame, cfg: TableConfig, set_name: str) -> DataFrame:
    """Project a source to one of its named column sets."""
    if set_name not in SET_NAMES:
        raise ConfigError(f"column set must be one of {', '.join(SET_NAMES)}; got {set_name!r}")
    return df.select(*select_fields(getattr(FieldSets(cfg, df.schema), set_name)))


def narrow(df: DataFrame, cfg: TableConfig) -> DataFrame:
    """Keep the payload columns, in schema order."""
    return project(df, cfg, "payload")
