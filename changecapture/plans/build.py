"""One change-capture run of one table."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changecapture import columns as C
from changecapture.config import INITIAL, ConfigError, TableConfig, version_name
from changecapture.functions.encoding import quoted
from changecapture.functions.hashing import add_hashes, match_columns
from changecapture.functions.wrap import unwrap
from changecapture.operators import keyed
from changecapture.operators.classify import (
    NEW,
    NEW_COPY,
    OLD,
    OLD_COPY,
    changed_keys,
    classify,
    classify_changed,
    delta_of,
    ranked,
)
from changecapture.operators.digests import among, carried_forward, differing, digests
from changecapture.operators.fields import narrow
from changecapture.operators.guards import (
    DuplicateKeys,
    action_counts,
    dedupe,
    duplicate_keys,
    require_unique,
)
from changecapture.sources.read import read_snapshot, read_table
from changecapture.tables import catalog, parts, periods, store
from changecapture.tables.claims import Claim, claimed
from changecapture.tables.names import identifier, partition_spec

class JobAlreadyFinished(ValueError):
    """The job has run before and later jobs have replaced its mirror."""


class BrokenMirror(RuntimeError):
    """The mirror holds a key more than once, so its rows cannot be labelled."""


@dataclass(frozen=True)
class BuildResult:
    """Outcome of a run: lazy views of its tables and the rows per label."""

    table: str
    job_id: str
    delta: DataFrame
    mirror: DataFrame
    counts: dict[str, int]


def load_source(spark: SparkSession, cfg: TableConfig) -> DataFrame:
    """The snapshot the settings name: a directory, or one partition of a source table."""
    if cfg.source_path:
        return read_snapshot(spark, cfg.source_path, cfg.source_format)
    if cfg.inline and not cfg.source_table:
        raise ConfigError(f"{cfg.table}: neither source_path nor source_table")
    source = read_table(spark, cfg.source_name)
    have = {c.lower() for c in source.columns}
    # a link points into one partition of the history; an inline table may take all of it
    columns = cfg.partition_values if cfg.inline else cfg.partition_columns
    missing = [c for c in columns if c not in have]
    if missing:
        raise ConfigError(f"{cfg.source_name}: no partition column {', '.join(missing)}")
    for column in columns:
        source = source.where(F.col(quoted(column)) == F.lit(cfg.partition_value(column)))
    return source


def hash_source(source: DataFrame, cfg: TableConfig) -> DataFrame:
    """Unwrap, narrow and hash a snapshot; drop repeated keys if the settings say so.

    Rows are ranked by the columns the join will use, so the join finds them already
    partitioned and sorted.
    """
    hashed = add_hashes(narrow(unwrap(source), cfg), cfg)
    if cfg.on_duplicates != "keep_first":
        return hashed
    return dedupe(hashed, match_columns(cfg, hashed), cfg.dedupe_order)


def create_objects(
    spark: SparkSession, cfg: TableConfig, schema: T.StructType | None = None
) -> str:
    """Create the mirror, or link table and view, if missing; returns the statements."""
    if schema is None:
        if cfg.inline:
            schema = load_source(spark, cfg).schema
        else:
            schema = read_table(spark, cfg.source_name).schema
    if cfg.inline:
        return catalog.create_mirror(spark, cfg, schema) + ";\n"
    if not spark.catalog.tableExists(cfg.source_name):
        raise ConfigError(f"{cfg.table}: no source table {cfg.source_name} to link to")
    link, view = catalog.create_link(spark, cfg, schema), catalog.link_view(spark, cfg)
    return f"{link};\n{view};\n"


def _result(spark: SparkSession, cfg: TableConfig) -> BuildResult:
    delta = spark.table(cfg.delta_name).where(F.col(C.JOB) == cfg.job_id)
    mirror = spark.table(cfg.mirror_name)
    version = spark.table(version_name(cfg.mirror_name, cfg.job_id))
    return BuildResult(cfg.table, cfg.job_id, delta, mirror, _counts(_found(version)))


def _found(version: DataFrame) -> dict[str, int]:
    """Rows per label: at most six rows, read from the partition values alone."""
    return {r[C.ACT]: r["rows"] for r in action_counts(version).collect()}


def _counts(found: dict[str, int]) -> dict[str, int]:
    return {act: found.get(act, 0) for act in (C.INSERT, C.UPDATE, C.DELETE, C.STATIONARY)}


def _has_run(spark: SparkSession, cfg: TableConfig) -> bool:
    if not spark.catalog.tableExists(cfg.delta_name):
        return False
    found = spark.sql(
        f"SHOW PARTITIONS {identifier(cfg.delta_name)} "
        f"PARTITION ({partition_spec({C.JOB: cfg.job_id})})"
    )
    return bool(found.take(1)) or periods.is_rolled(spark, cfg, cfg.job_id)


def _refuse_finished(
    spark: SparkSession, cfg: TableConfig, now: catalog.Versions, version: str
) -> None:
    """A job belongs to the past if the mirror showed it before, or if the delta has it."""
    past = version in (now.previous, now.outdated)
    if past or (now.pending != cfg.job_id and _has_run(spark, cfg)):
        raise JobAlreadyFinished(f"{cfg.table}: job {cfg.job_id} is in the delta already")


def _begin(
    spark: SparkSession, cfg: TableConfig, now: catalog.Versions, jobs: Sequence[str] = ()
) -> None:
    """Record the job on the mirror; undo another one that broke off before its switch.

    ``jobs`` are all jobs of a replay at once.
    """
    if now.pending and now.pending != cfg.job_id:
        left = version_name(cfg.mirror_name, now.pending)
        spark.sql(f"DROP TABLE IF EXISTS {identifier(_keys_name(left))}")
        parts.drop_version(spark, cfg.mirror_name, left, (now.current, now.previous, now.outdated))
        spark.sql(f"DROP TABLE IF EXISTS {identifier(left + '__days')}")
        if spark.catalog.tableExists(cfg.delta_name):
            for job in (now.pending, *catalog.replaying(spark, cfg.mirror_name)):
                catalog.drop_partition(spark, cfg.delta_name, {C.JOB: job})
    catalog.mark(spark, cfg.mirror_name, catalog.REPLAY, json.dumps(list(jobs)) if jobs else None)
    catalog.mark(spark, cfg.mirror_name, catalog.PENDING, cfg.job_id)


def _keys_name(version: str) -> str:
    return f"{version}__keys"


def _changes(
    spark: SparkSession,
    cfg: TableConfig,
    hashed: DataFrame,
    mirror: DataFrame,
    current: str,
    name: str,
) -> DataFrame:
    """Changed keys, written to a table: the planner then knows their size.

    With digests, only buckets whose digests differ are looked at.
    """
    if cfg.digest_buckets:
        before = _digests_of(spark, cfg, mirror, current)
        found = differing(digests(hashed, cfg.digest_buckets), before)
        hashed, mirror = (among(side, found, cfg.digest_buckets) for side in (hashed, mirror))
    keys = changed_keys(hashed, mirror, cfg).hint("rebalance")
    keys.write.format(catalog.FORMAT).mode("overwrite").saveAsTable(name)
    return spark.table(name)


def _digests_of(
    spark: SparkSession, cfg: TableConfig, mirror: DataFrame, current: str
) -> DataFrame:
    """Digests stored with the current version, or those of its rows if it was written without."""
    stored = parts.read_digests(spark, cfg.mirror_name, current, cfg.digest_buckets)
    return digests(mirror, cfg.digest_buckets) if stored is None else stored


def _write_digests(
    spark: SparkSession,
    cfg: TableConfig,
    mirror: DataFrame,
    changes: DataFrame | None,
    current: str,
    version: str,
) -> None:
    """Digests of the new version: those of the one before, carried forward by the changes."""
    n = cfg.digest_buckets
    if changes is None:
        rows = spark.table(version).where(F.col(C.ACT) != C.DELETE)
        after = digests(rows, n)
    else:
        sides = (
            digests(changes.where(F.col(side + C.VALUE_HASH).isNotNull()), n, value=side + C.VALUE_HASH, sign=F.lit(sign))
            for side, sign in ((NEW, 1), (OLD, -1))
        )
        after = carried_forward(_digests_of(spark, cfg, mirror, current), *sides)
    parts.write_digests(after, cfg.mirror_name, version, n)


def _write_touched(
    spark: SparkSession,
    cfg: TableConfig,
    hashed: DataFrame,
    changes: DataFrame | None,
    current: str,
    version: str,
) -> DataFrame:
    """Write the rows of the jobs a run touches; the other directories are carried over."""
    mirror = spark.table(cfg.mirror_name)
    if changes is None:
        rows = classify(hashed, mirror.where(F.lit(False)), cfg)
        parts.write_version(rows, cfg.mirror_name, version)
        return rows
    old_job = F.col(C.JOB)
    touched = {r[0] for r in changes.where(old_job.isNotNull()).select(C.JOB).distinct().collect()}
    listed = parts.manifest(spark, cfg.mirror_name, current)
    carried = parts.untouched(listed or (), touched)
    # by the names of the jobs, so that only their directories are read
    kept = [p.job for p in carried]
    rows = classify_changed(hashed, mirror.where(~old_job.isin(kept)), changes, cfg)
    parts.write_version(rows, cfg.mirror_name, version, carried)
    return rows


def _refuse_copies(source: DataFrame, cfg: TableConfig, found: dict[str, int]) -> None:
    """Second copies of a key in either side stop the run; nobody has seen its version yet."""
    if NEW_COPY in found:
        shown = duplicate_keys(source, cfg.keys).take(3)
        raise DuplicateKeys(f"{found[NEW_COPY]} keys occur more than once, among them {shown}")
    if OLD_COPY in found:
        raise BrokenMirror(f"{cfg.mirror_name}: {found[OLD_COPY]} keys occur more than once")


def build_delta(
    spark: SparkSession,
    cfg: TableConfig,
    snapshot: DataFrame | None = None,
    hashed: DataFrame | None = None,
) -> BuildResult:
    """Compare a snapshot with the mirror; add the changes to the delta, renew the mirror.

    Steps: classify and write the result once, as the version table of this job; refuse
    repeated keys; fill the delta from its changed rows; point the mirror view at it; drop
    the version before the last. Each step can be repeated. A run that broke off is repaired
    by running it again under the same job id, or undone by the next job; repeating a finished
    one changes nothing.

    The snapshot must read the same rows each time: it is evaluated for the check of a first
    load and for the write, and twice more with ``narrow_first``. Land a database table
    before, as ``ingest_jdbc`` does. Its columns may come in any order. ``hashed`` stands for it:
    the table that ``land_hashed`` wrote with these settings.

    Of two runs of a table at once, in whatever sessions, one raises ``TableBusy`` and has
    changed nothing.
    """
    if hashed is not None:
        snapshot = hashed.drop(*C.HASHES)
    source = load_source(spark, cfg) if snapshot is None else snapshot
    with claimed(spark, cfg.mirror_name) as claim:
        return _build_claimed(spark, cfg, source, hashed, claim)


def _build_claimed(
    spark: SparkSession, cfg: TableConfig, source: DataFrame, hashed: DataFrame | None, claim: Claim
) -> BuildResult:
    landed, version = hashed is not None, version_name(cfg.mirror_name, cfg.job_id)
    now = catalog.versions(spark, cfg.mirror_name)
    if now:
        store.drop_outdated(spark, cfg.mirror_name)
        if now.current == version:
            return _result(spark, cfg)
        _refuse_finished(spark, cfg, now, version)
    else:
        from_table = not cfg.inline and spark.catalog.tableExists(cfg.source_name)
        schema = None if from_table else unwrap(source).schema
        create_objects(spark, cfg, schema)
        now = catalog.versions(spark, cfg.mirror_name)
    _begin(spark, cfg, now)

    first = now.current == version_name(cfg.mirror_name, INITIAL)
    # the join tells repeated keys by itself; a run without the wide join counts them before
    count_first = cfg.on_duplicates == "fail" and (first or cfg.keys_first)
    checked = require_unique(unwrap(source), cfg.keys) if count_first else None
    plain = narrow(unwrap(source), cfg)
    by_key = not landed and keyed.applies(cfg, plain.schema)
    if by_key:
        hashed = keyed.kept_first(plain, cfg)
    elif not landed:
        hashed = hash_source(source, cfg)
    match = match_columns(cfg, hashed)
    if cfg.buckets and not landed:
        hashed = hashed.repartition(cfg.buckets, *match)
    mirror = spark.table(cfg.mirror_name)
    keys_name, changes = _keys_name(version), None
    try:
        if cfg.keys_first and not first:
            changes = _changes(spark, cfg, hashed, mirror, now.current, keys_name)
        if cfg.copy_on_write:
            rows = None
        elif first:
            # nothing to compare with: the empty side leaves no join behind
            plain = hashed.drop(*keyed.places(cfg)) if by_key else hashed
            rows = classify(plain, mirror.where(F.lit(False)), cfg)
        elif cfg.narrow_first:
            rows = classify_changed(hashed, mirror, changes, cfg)
        elif cfg.on_duplicates == "fail":
            rows = classify(ranked(hashed, match), ranked(mirror, match, repeats=False), cfg)
        elif by_key:
            rows = keyed.classify_kept(hashed, mirror, cfg)
        else:
            rows = classify(hashed, mirror, cfg)
        if cfg.copy_on_write:
            rows = _write_touched(spark, cfg, hashed, changes, now.current, version)
        else:
            store.write_mirror(
                rows,
                cfg.mirror_name,
                cfg.job_id,
                buckets=cfg.buckets,
                bucket_columns=match,
                rebalance=cfg.table_type == "fact",
            )
        if cfg.digest_buckets:
            _write_digests(spark, cfg, mirror, changes, now.current, version)
    finally:
        if cfg.keys_first:
            spark.sql(f"DROP TABLE IF EXISTS {identifier(keys_name)}")
    written = spark.table(version)
    found = _found(written)
    counts = _counts(found)
    kept = sum(n for act, n in counts.items() if act != C.DELETE)
    try:
        _refuse_copies(unwrap(source), cfg, found)
        if checked is not None and kept != checked:
            raise BrokenMirror(f"{cfg.mirror_name}: {checked} snapshot rows became {kept}")
    except (DuplicateKeys, BrokenMirror):
        parts.drop_version(spark, cfg.mirror_name, version, (now.current, now.previous))
        raise

    claim.commit()
    ordered = written.select(*[F.col(quoted(c)) for c in rows.columns])
    store.append_delta(delta_of(ordered), cfg.table, cfg.job_id)
    store.swap_mirror(spark, cfg.mirror_name, cfg.job_id)
    return BuildResult(
        cfg.table,
        cfg.job_id,
        spark.table(cfg.delta_name).where(F.col(C.JOB) == cfg.job_id),
        spark.table(cfg.mirror_name),
        counts,
    )


def run(spark: SparkSession, cfg: TableConfig):
    """Do what ``cfg.mode`` says: create objects, build a delta, or add a partition."""
    if cfg.mode == "ddl":
        return create_objects(spark, cfg)
    if cfg.mode == "delta":
        return build_delta(spark, cfg)
    spec = {c: cfg.partition_value(c) for c in cfg.partition_columns}
    return catalog.add_partition(spark, cfg.table, spec, cfg.source_path)
