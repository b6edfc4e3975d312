"""Catalog objects: mirror, link, link view, landing table, partitions."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from changecapture import columns as C
from changecapture.config import INITIAL, ConfigError, TableConfig, version_name
from changecapture.functions.encoding import quoted
from changecapture.operators.fields import FieldSets
from changecapture.tables.names import identifier, literal, partition_spec

FORMAT = "orc"
# these hold a different text in every row: looking for a dictionary is lost work
DIRECT = "orc.column.encoding.direct"
UNREPEATED = (C.NK, C.KEY_HASH, C.VALUE_HASH)
# properties of the mirror view: the version it shows, the one kept for its readers, the one
# to be dropped, and the one a run is writing
CURRENT, PREVIOUS = "changecapture.version", "changecapture.previous"
OUTDATED, PENDING = "changecapture.outdated", "changecapture.pending"
# all jobs of a replay at once that is at work
REPLAY = "changecapture.replay"
# property of a link view: what its text is made of
LINK = "changecapture.link"


def column_list(fields: Iterable[T.StructField]) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)


def storage_options(columns: Iterable[str]) -> dict[str, str]:
    """Writer options for a table with these columns."""
    direct = [c for c in columns if c in UNREPEATED]
    return {DIRECT: ",".join(direct)} if direct else {}


def create_table_sql(name: str, fields: list[T.StructField], partitioned_by: str) -> str:
    options = storage_options(f.name for f in fields)
    given = ", ".join(f"{literal(k)} = {literal(v)}" for k, v in options.items())
    return (
        f"CREATE TABLE IF NOT EXISTS {identifier(name)} ({column_list(fields)}) USING {FORMAT} "
        + (f"OPTIONS ({given}) " if given else "")
        + f"PARTITIONED BY ({quoted(partitioned_by)})"
    )


def _stored_fields(cfg: TableConfig, schema: T.StructType) -> list[T.StructField]:
    """Mirror columns: no label, and the partition column last."""
    fields = [f for f in FieldSets(cfg, schema).meta_table if f.name not in (C.ACT, C.JOB)]
    return [*fields, C.added_field(C.JOB)]


def mirror_ddl(cfg: TableConfig, schema: T.StructType) -> str:
    """DDL of the empty mirror (inline) or link table a first run compares with."""
    name = version_name(cfg.mirror_name, INITIAL)
    return create_table_sql(name, _stored_fields(cfg, schema), C.JOB)


def create_mirror(spark: SparkSession, cfg: TableConfig, schema: T.StructType) -> str:
    """Create mirror or link table if there is none yet; returns the DDL."""
    ddl = mirror_ddl(cfg, schema)
    if not spark.catalog.tableExists(cfg.mirror_name):
        spark.sql(ddl)
        point_at(spark, cfg.mirror_name, version_name(cfg.mirror_name, INITIAL))
    return ddl


def create_link(spark: SparkSession, cfg: TableConfig, schema: T.StructType) -> str:
    """Create the link table: hashes, keys and source partition columns, no payload."""
    if cfg.inline:
        raise ConfigError(f"{cfg.table}: an inline table has no link table")
    return create_mirror(spark, cfg, schema)


@dataclass(frozen=True)
class Versions:
    """Version tables of a mirror."""

    current: str
    previous: str | None = None
    outdated: str | None = None
    pending: str | None = None


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {identifier(name)}").collect()
    return {r["key"]: r["value"] for r in rows}


def versions(spark: SparkSession, mirror: str) -> Versions | None:
    """What the mirror view shows, showed before, and has to be tidied up; None without one."""
    if not spark.catalog.tableExists(mirror):
        return None
    found = properties(spark, mirror)
    if CURRENT not in found:
        raise ConfigError(f"{mirror} exists and is not a mirror of this library")
    return Versions(found[CURRENT], *(found.get(p) for p in (PREVIOUS, OUTDATED, PENDING)))


def replaying(spark: SparkSession, mirror: str) -> list[str]:
    """Jobs of a replay at once that broke off."""
    return json.loads(properties(spark, mirror).get(REPLAY, "[]"))


def mark(spark: SparkSession, mirror: str, name: str, value: str | None) -> None:
    """Set a property of the mirror view, or take it away."""
    change = (
        f"UNSET TBLPROPERTIES IF EXISTS ({literal(name)})"
        if value is None
        else f"SET TBLPROPERTIES ({literal(name)} = {literal(value)})"
    )
    spark.sql(f"ALTER VIEW {identifier(mirror)} {change}")


def point_at(
    spark: SparkSession,
    mirror: str,
    version: str,
    previous: str | None = None,
    outdated: str | None = None,
) -> None:
    """Let the mirror view show the rows of a version table: one catalog operation.

    The same operation records the version shown so far, and the one that may now go.
    """
    names = spark.table(version).columns
    front = [n for n in C.ADDED if n in names and n != C.ACT]
    shown = front + [n for n in names if not C.is_added(n)]
    given = {CURRENT: version}
    if previous:
        given[PREVIOUS] = previous
    if outdated:
        given[OUTDATED] = outdated
    pairs = ", ".join(f"{literal(k)} = {literal(v)}" for k, v in given.items())
    # the label is a partition column, so deleted rows are pruned and never read
    gone = f" WHERE {quoted(C.ACT)} <> {literal(C.DELETE)}" if C.ACT in names else ""
    spark.sql(
        f"CREATE OR REPLACE VIEW {identifier(mirror)} TBLPROPERTIES ({pairs}) AS "
        f"SELECT {', '.join(quoted(n) for n in shown)} FROM {identifier(version)}{gone}"
    )


def _link_parts(cfg: TableConfig, source_schema: T.StructType) -> dict:
    """What the text of a link view is made of."""
    sets = FieldSets(cfg, source_schema)
    names = {f.name.lower(): f.name for f in sets.payload}
    missing = [c for c in cfg.partition_columns if c not in names]
    if missing:
        raise ConfigError(f"{cfg.source_name}: no partition column {', '.join(missing)}")
    return {
        "view": cfg.table,
        "source": cfg.source_name,
        "link": cfg.mirror_name,
        "keys": [f.name for f in sets.ids],
        "partitions": [names[c] for c in cfg.partition_columns],
        "stamped": [f.name for f in sets.meta + sets.kv_hash if f.name != C.ACT],
        "payload": [f.name for f in sets.payload_metaex],
    }


def _among(columns: Sequence[str], rows: Iterable[tuple]) -> str:
    """Condition that is true of the given values of source columns, nulls included."""
    rows = list(rows)
    if not rows:
        return "false"
    name = f"s.{quoted(columns[0])}"
    below: dict = {}
    for value, *rest in rows:
        below.setdefault(value, []).append(tuple(rest))
    if len(columns) > 1:
        parts = []
        for value, rests in below.items():
            own = f"{name} IS NULL" if value is None else f"{name} = {literal(value)}"
            parts.append(f"({own} AND ({_among(columns[1:], rests)}))")
        return " OR ".join(parts)
    known = [literal(v) for v in below if v is not None]
    parts = [f"{name} IN ({', '.join(known)})"] if known else []
    return " OR ".join(parts + [f"{name} IS NULL"] * (None in below))


def _link_text(parts: dict, live: Iterable[tuple] | None) -> str:
    keys, partitions = parts["keys"], parts["partitions"]
    rows = None if live is None else sorted(set(live), key=str)
    on = [f"s.{quoted(k)} <=> n.{quoted(k)}" for k in keys]
    for at, name in enumerate(partitions):
        # plain equality lets a filter on the link prune the source while the query runs
        missing = rows is None or any(r[at] is None for r in rows)
        if name not in keys:
            on.append(f"s.{quoted(name)} {'<=>' if missing else '='} n.{quoted(name)}")
    shown = [f"n.{quoted(c)}" for c in parts["stamped"]]
    shown += [f"s.{quoted(c)}" for c in parts["payload"]]
    where = "" if rows is None else f" WHERE {_among(partitions, rows)}"
    return (
        f"CREATE OR REPLACE VIEW {identifier(parts['view'])} "
        f"TBLPROPERTIES ({literal(LINK)} = {literal(json.dumps(parts))}) AS "
        f"SELECT {', '.join(shown)} FROM {identifier(parts['source'])} s "
        f"JOIN {identifier(parts['link'])} n ON {' AND '.join(on)}{where}"
    )


def link_view_sql(
    cfg: TableConfig, source_schema: T.StructType, live: Iterable[tuple] | None = None
) -> str:
    """Text of the view that joins the source history to the link table.

    ``live`` are the source partitions that link rows point to, as values in the order of
    the partition columns. The view names them, so that a read lists and scans no others.
    Keys and partitions compare null-safe, so a key with an empty part, or a row of the
    partition for missing values, is not lost.
    """
    return _link_text(_link_parts(cfg, source_schema), live)


def live_pointers(rows: DataFrame, partitions: Sequence[str]) -> list[tuple]:
    """Source partitions that link rows point to: as many as the catalog lists at most."""
    return [tuple(r) for r in rows.select(*[quoted(p) for p in partitions]).distinct().collect()]


def link_view(spark: SparkSession, cfg: TableConfig) -> str:
    """Create the view ``<table>`` over source history and link table; returns its text.

    It names the partitions in use now; ``swap_mirror`` of the link table renews it.
    """
    parts = _link_parts(cfg, spark.table(cfg.source_name).schema)
    text = _link_text(parts, live_pointers(spark.table(cfg.mirror_name), parts["partitions"]))
    spark.sql(text)
    return text


def linked(spark: SparkSession, mirror: str) -> dict | None:
    """What the view over a link table is made of; None if ``mirror`` is none, or has no view."""
    view = mirror.removesuffix("_nklink")
    if view == mirror or not spark.catalog.tableExists(view):
        return None
    parts = json.loads(properties(spark, view).get(LINK, "null"))
    return parts if parts and parts["link"] == mirror else None


def renew_link_view(spark: SparkSession, parts: dict, live: Iterable[tuple]) -> None:
    spark.sql(_link_text(parts, live))


def create_landing(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    root: str,
    fmt: str = "parquet",
    partitioned_by: T.StructType | str = "export_date",
) -> str:
    """Create a table over landed files. Days are registered with ``add_partition``."""
    if isinstance(partitioned_by, str):
        parts = [
            T.StructField(n.strip(), T.StringType()) for n in partitioned_by.split(",") if n.strip()
        ]
    else:
        parts = list(partitioned_by.fields)
    names = {p.name.lower() for p in parts}
    fields = [f for f in schema.fields if f.name.lower() not in names] + parts
    ddl = (
        f"CREATE TABLE IF NOT EXISTS {identifier(table)} ({column_list(fields)}) USING {fmt} "
        f"PARTITIONED BY ({', '.join(quoted(p.name) for p in parts)}) LOCATION {literal(root)}"
    )
    spark.sql(ddl)
    return ddl


def add_partitions(
    spark: SparkSession, table: str, partitions: Iterable[tuple[Mapping[str, Any], str | None]]
) -> None:
    """Register directories as partitions, in one catalog call; known ones are left alone."""
    clauses = [
        f"PARTITION ({partition_spec(spec)})" + (f" LOCATION {literal(path)}" if path else "")
        for spec, path in partitions
    ]
    if clauses:
        spark.sql(f"ALTER TABLE {identifier(table)} ADD IF NOT EXISTS {' '.join(clauses)}")
    refresh(spark, table)


def add_partition(
    spark: SparkSession, table: str, spec: Mapping[str, Any], location: str | None = None
) -> None:
    """Register one directory as a partition."""
    add_partitions(spark, table, [(spec, location)])


def drop_partitions(
    spark: SparkSession, table: str, specs: Iterable[Mapping[str, Any]]
) -> None:
    """Unregister partitions, in one catalog call; the files of an external table stay."""
    clauses = ", ".join(f"PARTITION ({partition_spec(spec)})" for spec in specs)
    if clauses:
        spark.sql(f"ALTER TABLE {identifier(table)} DROP IF EXISTS {clauses}")
    refresh(spark, table)


def drop_partition(spark: SparkSession, table: str, spec: Mapping[str, Any]) -> None:
    """Unregister one partition."""
    drop_partitions(spark, table, [spec])


def list_partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {identifier(table)}")


def refresh(spark: SparkSession, table: str) -> None:
    """Forget cached file listings."""
    spark.catalog.refreshTable(table)
