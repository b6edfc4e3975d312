"""Delta history at length: closed jobs rolled into periods, with statistics of each job.

``<table>_delta`` keeps a partition for each open job. ``<table>_delta_rolled`` holds the rows of
closed jobs by period, sorted by job, so that the number of files follows the bytes and not the
jobs. ``<table>_delta_jobs`` says what each rolled job did. The view ``<table>_delta_all`` shows
both; which periods count is a property of the view, so a period shows with one catalog operation.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changecapture import columns as C
from changecapture.config import TableConfig
from changecapture.functions.encoding import quoted
from changecapture.tables import catalog
from changecapture.tables.names import identifier, literal, partition_spec, partition_values

PERIOD = "DWSPERIOD"
#: Statistics of a job: rows in all and by label.
ROWS = "rows"
LABELS = {"inserted": C.INSERT, "updated": C.UPDATE, "deleted": C.DELETE}
# properties of the view: first and last job of each period, and periods whose jobs still have
# partitions of their own
ROLLED, RETIRED = "changecapture.rolled", "changecapture.retired"


@dataclass(frozen=True)
class Periods:
    """Periods that show, with their first and last job, and those with partitions left over."""

    rolled: dict[str, list[str]] = field(default_factory=dict)
    retired: tuple[str, ...] = ()


def all_name(cfg: TableConfig) -> str:
    return f"{cfg.delta_name}_all"


def rolled_name(cfg: TableConfig) -> str:
    return f"{cfg.delta_name}_rolled"


def jobs_name(cfg: TableConfig) -> str:
    return f"{cfg.delta_name}_jobs"


def periods(spark: SparkSession, cfg: TableConfig) -> Periods:
    """What is rolled; nothing while no job was."""
    if not spark.catalog.tableExists(all_name(cfg)):
        return Periods()
    found = catalog.properties(spark, all_name(cfg))
    return Periods(json.loads(found[ROLLED]), tuple(json.loads(found[RETIRED])))


def open_jobs(spark: SparkSession, cfg: TableConfig) -> list[str]:
    """Jobs with a partition of their own, those without changes included."""
    listed = catalog.list_partitions(spark, cfg.delta_name).collect()
    return sorted(partition_values(r[0])[C.JOB] for r in listed)


def job_statistics(spark: SparkSession, cfg: TableConfig) -> DataFrame | None:
    """One row per rolled job: its period, its rows, and its rows by label; None if none is rolled."""
    shown = list(periods(spark, cfg).rolled)
    if not shown:
        return None
    return spark.table(jobs_name(cfg)).where(F.col(PERIOD).isin(shown))


def is_rolled(spark: SparkSession, cfg: TableConfig, job: str) -> bool:
    found = job_statistics(spark, cfg)
    return found is not None and not found.where(F.col(C.JOB) == job).isEmpty()


def write_period(spark: SparkSession, cfg: TableConfig, period: str, jobs: list[str]) -> None:
    """Write the rows and the statistics of open jobs as a period, which nobody sees yet.

    The range partitioning is by job and key hash, so a job that holds much of the history is
    split, and adaptive execution puts small jobs together.
    """
    delta = spark.table(cfg.delta_name)
    order = [c for c in (C.JOB, C.KEY_HASH) if c in delta.columns]
    rows = delta.where(F.col(C.JOB).isin(jobs))
    label = T.StructField(PERIOD, T.StringType())
    name, spec = rolled_name(cfg), partition_spec({PERIOD: period})
    spark.sql(catalog.create_table_sql(name, [*delta.schema.fields, label], PERIOD))
    spark.sql(
        f"INSERT OVERWRITE TABLE {identifier(name)} PARTITION ({spec}) "
        f"SELECT {', '.join(quoted(c) for c in delta.columns)} FROM {{rows}}",
        rows=rows.repartitionByRange(*order).sortWithinPartitions(*order),
    )
    catalog.refresh(spark, name)

    done = spark.table(name).where(F.col(PERIOD) == period).groupBy(C.JOB)
    counted = done.agg(
        F.count("*").alias(ROWS),
        *[F.count_if(F.col(C.ACT) == act).alias(name) for name, act in LABELS.items()],
    )
    every = spark.createDataFrame([(j,) for j in jobs], f"{C.JOB} string")
    counts = [ROWS, *LABELS]
    # a job without changes has run, and is listed with no rows
    listed = every.join(counted, C.JOB, "left").fillna(0, counts).select(C.JOB, *counts)
    spark.sql(catalog.create_table_sql(jobs_name(cfg), [*listed.schema.fields, label], PERIOD))
    spark.sql(
        f"INSERT OVERWRITE TABLE {identifier(jobs_name(cfg))} PARTITION ({spec}) "
        "SELECT * FROM {rows}",
        rows=listed.coalesce(1),
    )
    catalog.refresh(spark, jobs_name(cfg))


def rows_of_period(spark: SparkSession, cfg: TableConfig, period: str) -> int:
    listed = spark.table(jobs_name(cfg)).where(F.col(PERIOD) == period)
    return listed.agg(F.sum(ROWS)).first()[0] or 0


def jobs_of(spark: SparkSession, cfg: TableConfig, shown: Iterable[str]) -> list[str]:
    """Jobs rolled into periods: as many as the catalog had partitions."""
    found = spark.table(jobs_name(cfg)).where(F.col(PERIOD).isin(list(shown)))
    return sorted(r[0] for r in found.select(C.JOB).collect())


def show(spark: SparkSession, cfg: TableConfig, state: Periods) -> None:
    """Let the view ``<table>_delta_all`` show these periods: one catalog operation.

    A period is a branch of its own with its first and last job as bounds: a query that asks for
    one job loses the other branches when it is planned. Retired jobs show from their period.
    """
    names = ", ".join(quoted(c) for c in spark.table(cfg.delta_name).columns)
    job, own = quoted(C.JOB), identifier(cfg.delta_name)
    retired = jobs_of(spark, cfg, state.retired) if state.retired else []
    gone = f" WHERE {job} NOT IN ({', '.join(literal(j) for j in retired)})" if retired else ""
    branches = [f"SELECT {names} FROM {own}{gone}"]
    for period, (first, last) in sorted(state.rolled.items()):
        branches.append(
            f"SELECT {names} FROM {identifier(rolled_name(cfg))} "
            f"WHERE {quoted(PERIOD)} = {literal(period)} "
            f"AND {job} >= {literal(first)} AND {job} <= {literal(last)}"
        )
    pairs = {ROLLED: json.dumps(state.rolled), RETIRED: json.dumps(state.retired)}
    given = ", ".join(f"{literal(k)} = {literal(v)}" for k, v in pairs.items())
    spark.sql(
        f"CREATE OR REPLACE VIEW {identifier(all_name(cfg))} TBLPROPERTIES ({given}) AS "
        + " UNION ALL ".join(branches)
    )


def drop_retired(spark: SparkSession, cfg: TableConfig) -> Periods:
    """Drop the partitions of jobs that were rolled before; returns what is left."""
    state = periods(spark, cfg)
    if state.retired:
        left = set(jobs_of(spark, cfg, state.retired)) & set(open_jobs(spark, cfg))
        catalog.drop_partitions(spark, cfg.delta_name, [{C.JOB: job} for job in sorted(left)])
        state = Periods(state.rolled)
        show(spark, cfg, state)
    return state


def read_delta(
    spark: SparkSession, cfg: TableConfig, jobs: Iterable[str] | None = None
) -> DataFrame:
    """The changes of all jobs, or of some, wherever they are.

    Of the rolled history only the periods that hold one of the jobs are read, as the statistics
    tell, and of their files only the stripes whose range of jobs fits.
    """
    state = periods(spark, cfg)
    delta = spark.table(cfg.delta_name)
    if jobs is None:
        return spark.table(all_name(cfg)) if state.rolled else delta
    asked = sorted(set(jobs))
    wanted = F.col(C.JOB).isin(asked)
    if not state.rolled:
        return delta.where(wanted)
    found = job_statistics(spark, cfg).where(wanted).select(C.JOB, PERIOD).collect()
    kept = [j for j in asked if j not in {r[C.JOB] for r in found}]
    out = delta.where(F.col(C.JOB).isin(kept))
    if not found:
        return out
    rolled = spark.table(rolled_name(cfg))
    rolled = rolled.where(F.col(PERIOD).isin(sorted({r[PERIOD] for r in found})))
    rolled = rolled.where(F.col(C.JOB).isin(sorted({r[C.JOB] for r in found})))
    return out.unionByName(rolled.select(*[quoted(c) for c in delta.columns]))
