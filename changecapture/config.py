"""Per-table settings of a change-capture run."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from hashlib import md5
from typing import Any

HASH_KINDS = ("md5", "sha", "murmur", "xxhash")
# Too short to tell keys apart on a large table: rows are then matched on the
# key columns as well as on the key hash.
SHORT_HASH_KINDS = ("murmur", "xxhash")
TABLE_TYPES = ("dim", "fact")
MODES = ("ddl", "delta", "add-partition")
DUPLICATE_POLICIES = ("fail", "keep_first")


#: Buckets that digests are kept for; their numbers are sent to every task.
MOST_DIGESTS = 1 << 16

#: Stands for a job in the name of the empty mirror that a first run compares with.
INITIAL = "init"


class ConfigError(ValueError):
    """A setting, or a setting and a schema, that cannot work together."""


def name_list(names: str | Iterable[str] | None) -> tuple[str, ...]:
    """Split, trim and lower-case a list of column names; empty names are dropped."""
    if names is None:
        return ()
    parts = names.split(",") if isinstance(names, str) else names
    out: list[str] = []
    for part in parts:
        name = part.strip().lower()
        if name and name not in out:
            out.append(name)
    return tuple(out)


def _choice(value: str, allowed: tuple[str, ...], what: str) -> str:
    value = value.strip().lower()
    if value not in allowed:
        raise ConfigError(f"{what} must be one of {', '.join(allowed)}; got {value!r}")
    return value


@dataclass(frozen=True)
class TableConfig:
    """Settings of one table for one run.

    ``keys``, ``exclusions``, ``partition_columns`` and ``dedupe_order`` take a
    comma-separated string or a sequence and are matched without regard to case.

    ``partition_values`` names the source partition this run loads, one value per
    partition column. A missing value is the job id, which is only possible for a
    single partition column.

    ``buckets`` stores the mirror in that many buckets of the match columns, so that
    the next run joins it without shuffling it. It suits large dimension tables; a
    fact mirror has a partition per job and would be cut into too many files.

    ``narrow_first`` finds the changed keys from the hashes alone, writes them to a table and
    joins them back. It reads both sides twice and suits wide inline tables that change little:
    the planner sees how small the changed keys are and then shuffles no wide row.

    ``copy_on_write`` keeps the files of a fact mirror whose job partitions a run does not touch:
    the next version refers to them, and files written follow the change. It finds the changed
    keys like ``narrow_first``.

    ``digest_buckets`` keeps a digest for that many buckets of the mirror's rows, and compares
    those of the snapshot with them first: only rows of buckets that differ are joined. It goes with
    ``narrow_first`` or ``copy_on_write``. Choose so many that few of them change.

    ``nk_scope`` sets the surrogate keys of this table apart from those of other tables;
    it is the table name unless given.
    """

    table: str
    keys: Any
    table_type: str = "dim"
    exclusions: Any = ()
    partition_columns: Any = ("export_date",)
    partition_values: Mapping[str, Any] | str | None = None
    hash_kind: str = "md5"
    inline: bool = True
    mode: str = "delta"
    source_path: str | None = None
    source_format: str = "parquet"
    source_table: str | None = None
    on_duplicates: str = "fail"
    dedupe_order: Any = ()
    buckets: int | None = None
    narrow_first: bool = False
    copy_on_write: bool = False
    digest_buckets: int | None = None
    nk_scope: str | None = None
    job_id: str = field(default_factory=lambda: str(uuid.uuid4()))

    def __post_init__(self) -> None:
        put = lambda name, value: object.__setattr__(self, name, value)
        for name in ("keys", "exclusions", "partition_columns", "dedupe_order"):
            put(name, name_list(getattr(self, name)))
        put("table_type", _choice(self.table_type, TABLE_TYPES, "table_type"))
        put("hash_kind", _choice(self.hash_kind, HASH_KINDS, "hash_kind"))
        put("mode", _choice(self.mode, MODES, "mode"))
        put("on_duplicates", _choice(self.on_duplicates, DUPLICATE_POLICIES, "on_duplicates"))
        if not self.table:
            raise ConfigError("table is empty")
        if not self.keys:
            raise ConfigError(f"{self.table}: no key columns")
        if not self.job_id:
            raise ConfigError(f"{self.table}: job_id is empty")
        if self.job_id.lower() == INITIAL:
            raise ConfigError(f"{self.table}: {INITIAL!r} names the empty mirror, not a job")
        both = [k for k in self.keys if k in self.exclusions]
        if both:
            raise ConfigError(f"{self.table}: both key and excluded: {', '.join(both)}")
        put("nk_scope", self.nk_scope or self.table.lower())
        put("partition_values", self._values())
        if not self.inline and self.on_duplicates != "fail":
            raise ConfigError(f"{self.table}: a link cannot tell copies of a key apart")
        if self.narrow_first and (not self.inline or self.match_on_keys or self.buckets):
            raise ConfigError(
                f"{self.table}: narrow_first needs an inline table, a long hash and no buckets"
            )
        if self.copy_on_write and (
            not self.inline or self.match_on_keys or self.table_type != "fact"
        ):
            raise ConfigError(
                f"{self.table}: copy_on_write needs an inline fact table and a long hash"
            )
        if self.digest_buckets is not None:
            if not self.keys_first:
                raise ConfigError(
                    f"{self.table}: digest_buckets needs narrow_first or copy_on_write"
                )
            if not 0 < self.digest_buckets <= MOST_DIGESTS:
                raise ConfigError(f"{self.table}: digest_buckets must be 1 to {MOST_DIGESTS}")
        if self.buckets is not None:
            if self.buckets < 1:
                raise ConfigError(f"{self.table}: buckets must be positive")
            if self.table_type == "fact":
                raise ConfigError(f"{self.table}: buckets are for dimension tables")

    def _values(self) -> dict[str, Any]:
        given = self.partition_values
        if not given and given != 0:
            return {}
        if not isinstance(given, Mapping):
            if len(self.partition_columns) != 1:
                raise ConfigError(f"{self.table}: give one value per partition column")
            given = {self.partition_columns[0]: given}
        values = {name.strip().lower(): value for name, value in given.items()}
        if set(values) != set(self.partition_columns):
            raise ConfigError(
                f"{self.table}: partition values for {sorted(values)}, "
                f"partition columns are {sorted(self.partition_columns)}"
            )
        empty = sorted(name for name, value in values.items() if value is None)
        if empty:
            raise ConfigError(f"{self.table}: no value for partition column {', '.join(empty)}")
        return values

    def partition_value(self, column: str) -> Any:
        """Value of a source partition column in this run; the job id unless given."""
        if not self.partition_values:
            if len(self.partition_columns) != 1:
                raise ConfigError(f"{self.table}: give one value per partition column")
            return self.job_id
        return self.partition_values[column.lower()]

    @property
    def match_on_keys(self) -> bool:
        return self.hash_kind in SHORT_HASH_KINDS

    @property
    def keys_first(self) -> bool:
        """Whether the changed keys are found before any wide row is read."""
        return self.narrow_first or self.copy_on_write

    @property
    def value_hash_kind(self) -> str:
        """Short hashes would lose updates: two values of a key may share one."""
        return "md5" if self.hash_kind in SHORT_HASH_KINDS else self.hash_kind

    @property
    def mirror_name(self) -> str:
        """Catalog name that always shows the current mirror (or link) rows."""
        return self.table if self.inline else f"{self.table}_nklink"

    @property
    def delta_name(self) -> str:
        return f"{self.table}_delta"

    @property
    def source_name(self) -> str:
        """Partitioned source history a link table points into."""
        return self.source_table or f"{self.table}_src"


def version_name(mirror: str, job_id: str) -> str:
    """Catalog name of the mirror rows written by one job."""
    safe = re.sub(r"[^0-9a-z_]", "_", job_id.lower())
    if safe != job_id:
        safe = f"{safe}_{md5(job_id.encode()).hexdigest()[:8]}"
    return f"{mirror}__{safe}"
