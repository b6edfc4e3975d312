"""Replay many days at once: one shuffle for all of them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changecapture import columns as C
from changecapture.config import INITIAL, ConfigError, TableConfig, version_name
from changecapture.functions.encoding import quoted
from changecapture.functions.hashing import identity, match_columns
from changecapture.operators.classify import NEW_COPY, assign_nk
from changecapture.operators.guards import DuplicateKeys
from changecapture.plans.build import BuildResult, _begin, _refuse_finished, create_objects, hash_source
from changecapture.functions.wrap import unwrap
from changecapture.tables import catalog, periods, store
from changecapture.tables.claims import Claim, claimed

_DAY, _BORN, _SHOWN, _NEXT, _LABELS = "__day", "__born", "__shown", "__next", "__labels"


def _stacked(mirror: DataFrame, days: list[DataFrame], cfg: TableConfig) -> DataFrame:
    """The mirror as day 0, and the snapshots after it, in one set of rows."""
    carried = C.NK if cfg.table_type == "dim" else C.JOB
    names = days[0].columns
    rows = [
        mirror.select(
            F.lit(0).alias(_DAY), *[F.col(quoted(c)) for c in names], F.col(carried).alias(_BORN)
        )
    ]
    for number, day in enumerate(days, 1):
        born = F.lit(None).cast("string").alias(_BORN)
        rows.append(day.select(F.lit(number).alias(_DAY), *[F.col(quoted(c)) for c in names], born))
    return reduce(DataFrame.unionByName, rows)


def history(
    mirror: DataFrame, days: list[tuple[str, DataFrame]], cfg: TableConfig
) -> DataFrame:
    """Every change of every day, and the rows that the last day leaves unchanged.

    ``days`` are job ids and hashed snapshots, in order. The rows are those that one run after
    the other would label: ``I``, ``U`` and ``D`` of each job, and ``S`` of the last. All days
    are sorted by key once; the row before tells what is new, the row after what is gone, and the
    last inserted or updated row is the one that stationary and deleted rows show.
    """
    jobs = [job for job, _ in days]
    if len(set(jobs)) < len(jobs):
        raise ConfigError(f"{cfg.table}: a job id occurs twice")
    rows = _stacked(mirror, [day for _, day in days], cfg)
    match = [F.col(quoted(c)) for c in match_columns(cfg, days[0][1])]
    by_key = Window.partitionBy(*match).orderBy(_DAY)
    upto = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    payload = [c for c in days[0][1].columns if not C.is_added(c)]

    before, value_before = F.lag(_DAY).over(by_key), F.lag(C.VALUE_HASH).over(by_key)
    label = (
        F.when(F.col(_DAY) == before, NEW_COPY)
        .when(F.col(_DAY) == 0, C.STATIONARY)
        .when(before.isNull() | (before < F.col(_DAY) - 1), C.INSERT)
        .when(F.col(C.VALUE_HASH) == value_before, C.STATIONARY)
        .otherwise(C.UPDATE)
    )
    job = F.get(F.array(F.lit(None).cast("string"), *[F.lit(j) for j in jobs]), F.col(_DAY))
    rows = rows.withColumn(C.ACT, label).withColumn(_NEXT, F.lead(_DAY).over(by_key))
    # what came with a row stays until the next one of the key that is inserted or updated
    fresh = (F.col(C.ACT) != C.STATIONARY) | (F.col(_DAY) == 0)
    written = F.when(
        fresh, F.struct(job.alias(C.JOB), F.col(_BORN), C.VALUE_HASH, *[quoted(c) for c in payload])
    )
    born = F.when((F.col(C.ACT) == C.INSERT) | (F.col(_DAY) == 0), F.struct(job.alias(C.JOB), _BORN))
    rows = rows.select(
        F.col(_DAY), _NEXT, C.KEY_HASH, C.ACT, *[quoted(c) for c in payload if c.lower() in cfg.keys],
        F.last(written, True).over(upto).alias(_SHOWN),
        F.last(born, True).over(upto).alias(_BORN),
    )

    own = F.struct(F.col(_DAY).alias("day"), F.col(C.ACT).alias("act"))
    gone = F.struct((F.col(_DAY) + 1).alias("day"), F.lit(C.DELETE).alias("act"))
    ends = (F.col(_DAY) < len(jobs)) & (F.col(_NEXT).isNull() | (F.col(_NEXT) > F.col(_DAY) + 1))
    kept = (F.col(C.ACT) != C.STATIONARY) | (F.col(_DAY) == len(jobs))
    both = F.filter(F.array(F.when(kept, own), F.when(ends, gone)), lambda e: e.isNotNull())
    rows = rows.withColumn(_LABELS, F.explode(both)).withColumn(_DAY, F.col(f"{_LABELS}.day"))
    act = F.col(f"{_LABELS}.act")
    stamps = {
        C.JOB: job,
        C.UNIACT: F.lit(None).cast("string"),
        C.AUTO: F.lit("N"),
        C.ARCHIVE: F.when(act == C.DELETE, "Y").otherwise("N"),
        C.ACT: act,
    }
    if cfg.table_type == "dim":
        key = identity(cfg, days[0][1])
        keys = [
            F.when(F.col(f"{_BORN}.{C.JOB}") == j, assign_nk(replace(cfg, job_id=j), key)) for j in jobs
        ]
        stamps[C.NK] = F.coalesce(F.col(f"{_BORN}.{_BORN}"), *keys)
    else:
        last = F.coalesce(F.col(f"{_SHOWN}.{C.JOB}"), F.col(f"{_SHOWN}.{_BORN}"))
        stamps[C.JOB] = F.when(act == C.STATIONARY, last).otherwise(job)
    return rows.where(act != "").select(
        F.col(_DAY),
        *[stamps[n].alias(n) for n in C.lineage(cfg.table_type)],
        C.KEY_HASH,
        F.col(f"{_SHOWN}.{C.VALUE_HASH}").alias(C.VALUE_HASH),
        *[F.col(f"{_SHOWN}.{quoted(c)}").alias(c) for c in payload],
    )


def replay_at_once(
    spark: SparkSession, cfg: TableConfig, snapshots: Iterable[tuple[str, DataFrame]]
) -> list[BuildResult]:
    """What ``replay`` does day by day, with one shuffle for all days; inline tables only.

    The changes of all days go to a table, then by job to the delta, and the mirror is
    switched once, to what the last day leaves. A replay that broke off is repaired by running it
    again; another job undoes it. Job ids must be new, and a key may occur once a day.
    """
    days = list(snapshots)
    if not days:
        return []
    if not cfg.inline or cfg.on_duplicates != "fail" or cfg.buckets or cfg.keys_first:
        raise ConfigError(f"{cfg.table}: replay_at_once takes inline tables without further settings")
    with claimed(spark, cfg.mirror_name) as claim:
        return _replay_claimed(spark, replace(cfg, job_id=days[-1][0]), days, claim)


def _replay_claimed(
    spark: SparkSession, cfg: TableConfig, days: list[tuple[str, DataFrame]], claim: Claim
) -> list[BuildResult]:
    jobs, version = [job for job, _ in days], version_name(cfg.mirror_name, days[-1][0])
    now = catalog.versions(spark, cfg.mirror_name)
    if now is None:
        create_objects(spark, cfg, unwrap(days[0][1]).schema)
        now = catalog.versions(spark, cfg.mirror_name)
    store.drop_outdated(spark, cfg.mirror_name)
    if now.current != version:
        for job in jobs:
            own = replace(cfg, job_id=job)
            if job not in catalog.replaying(spark, cfg.mirror_name):
                _refuse_finished(spark, own, now, version_name(cfg.mirror_name, job))
        _begin(spark, cfg, now, jobs)
        hashed = [(job, hash_source(day, cfg)) for job, day in days]
        mirror = spark.table(cfg.mirror_name)
        if now.current == version_name(cfg.mirror_name, INITIAL):
            mirror = mirror.where(F.lit(False))
        rows = history(mirror, hashed, cfg)
        # by day and label, so that each delta and the mirror read their own directories
        name = f"{version}__days"
        rows.hint("rebalance", _DAY, C.ACT).write.format(catalog.FORMAT).mode("overwrite").partitionBy(
            _DAY, C.ACT
        ).saveAsTable(name)
        done = spark.table(name)
        copies = done.where(F.col(C.ACT) == NEW_COPY).count()
        if copies:
            spark.sql(f"DROP TABLE IF EXISTS {catalog.identifier(name)}")
            raise DuplicateKeys(f"{cfg.table}: {copies} keys occur more than once a day")
        columns = [F.col(quoted(c)) for c in rows.columns if c != _DAY]
        last = done.where(F.col(_DAY) == len(days)).select(*columns)
        rebalance = cfg.table_type == "fact"
        store.write_mirror(last, cfg.mirror_name, cfg.job_id, rebalance=rebalance)
        claim.commit()
        for number, job in enumerate(jobs, 1):
            own = done.where((F.col(_DAY) == number) & (F.col(C.ACT) != C.STATIONARY))
            store.append_delta(own.select(*columns), cfg.table, job)
        store.swap_mirror(spark, cfg.mirror_name, cfg.job_id)
        spark.sql(f"DROP TABLE IF EXISTS {catalog.identifier(name)}")
    return [_of(spark, cfg, job) for job in jobs]


def _of(spark: SparkSession, cfg: TableConfig, job: str) -> BuildResult:
    delta = periods.read_delta(spark, cfg, [job])
    counts = {r[C.ACT]: r["count"] for r in delta.groupBy(C.ACT).count().collect()}
    counts = {act: counts.get(act, 0) for act in (C.INSERT, C.UPDATE, C.DELETE)}
    return BuildResult(cfg.table, job, delta, spark.table(cfg.mirror_name), counts)
