"""Roll the delta partitions of closed jobs into periods."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from changecapture import columns as C
from changecapture.config import ConfigError, TableConfig, version_name
from changecapture.tables import catalog, periods
from changecapture.tables.claims import claimed


class IncompletePeriod(RuntimeError):
    """A period does not hold as many rows as the jobs it was rolled from."""


def compact_delta(
    spark: SparkSession, cfg: TableConfig, period: str, jobs: Iterable[str] | None = None
) -> list[str]:
    """Roll closed jobs of a table into a new period; returns the jobs.

    A job is closed once a later one has replaced its mirror. Without ``jobs`` all closed jobs
    are rolled. Their rows show from the period at once; their partitions stay until the next
    call, or ``drop_rolled``, for queries planned before. A call that broke off is repaired by
    repeating it. A run of the table at the same time raises ``TableBusy``.
    """
    with claimed(spark, cfg.mirror_name) as claim:
        state = periods.drop_retired(spark, cfg)
        if period in state.rolled:
            raise ConfigError(f"{cfg.table}: period {period} is rolled already")
        own = periods.open_jobs(spark, cfg)
        now = catalog.versions(spark, cfg.mirror_name)
        busy = {now.pending, *catalog.replaying(spark, cfg.mirror_name)}
        closed = [
            j for j in own if j not in busy and version_name(cfg.mirror_name, j) != now.current
        ]
        chosen = closed if jobs is None else sorted(set(jobs))
        if not set(chosen) <= set(closed):
            raise ConfigError(f"{cfg.table}: not closed: {sorted(set(chosen) - set(closed))}")
        if not chosen:
            return []
        periods.write_period(spark, cfg, period, chosen)
        wanted = spark.table(cfg.delta_name).where(F.col(C.JOB).isin(chosen)).count()
        found = periods.rows_of_period(spark, cfg, period)
        if found != wanted:
            raise IncompletePeriod(f"{cfg.table}: period {period} has {found} of {wanted} rows")
        claim.commit()
        rolled = {**state.rolled, period: [chosen[0], chosen[-1]]}
        periods.show(spark, cfg, periods.Periods(rolled, (period,)))
    return chosen


def drop_rolled(spark: SparkSession, cfg: TableConfig) -> None:
    """Drop the partitions that rolled jobs left behind, before the next compaction does."""
    with claimed(spark, cfg.mirror_name):
        periods.drop_retired(spark, cfg)
