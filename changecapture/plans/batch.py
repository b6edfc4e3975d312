"""Many tables, or many days."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from changecapture.config import TableConfig
from changecapture.plans.build import BuildResult, build_delta
from changecapture.sources.ingest import land_partition
from changecapture.sources.read import read_landing
from changecapture.tables import catalog

POOL = "spark.scheduler.pool"
Extract = Callable[[SparkSession], DataFrame]


@dataclass(frozen=True)
class DeltaStep:
    """Land a day's extract, then capture its changes."""

    config: TableConfig
    extract: Extract
    root: str
    day: str
    fmt: str = "parquet"
    column: str = "export_date"

    @property
    def table(self) -> str:
        return self.config.table

    def __call__(self, spark: SparkSession) -> BuildResult:
        land_partition(self.extract(spark), self.root, self.day, self.fmt, self.column)
        landed = read_landing(spark, self.root, self.day, self.fmt, self.column)
        return build_delta(spark, self.config, landed.drop(self.column))


@dataclass(frozen=True)
class PartitionStep:
    """Land a day's extract, then register it as a partition of a landing table."""

    table: str
    extract: Extract
    root: str
    day: str
    fmt: str = "parquet"
    column: str = "export_date"

    def __call__(self, spark: SparkSession) -> DataFrame:
        df = self.extract(spark)
        path = land_partition(df, self.root, self.day, self.fmt, self.column)
        catalog.create_landing(spark, self.table, df.schema, self.root, self.fmt, self.column)
        catalog.add_partition(spark, self.table, {self.column: self.day}, path)
        return spark.table(self.table)


class BatchFailed(RuntimeError):
    """Some tables of a batch failed; the others are done."""

    def __init__(self, errors: dict[str, Exception], done: dict[str, object]):
        self.errors, self.done = errors, done
        told = "; ".join(f"{t}: {type(e).__name__}: {e}" for t, e in errors.items())
        super().__init__(f"{len(errors)} of {len(errors) + len(done)} tables failed: {told}")


def _size(spark: SparkSession, step: DeltaStep | PartitionStep) -> float:
    """Bytes of a step's table as the planner knows them, nothing being read for it."""
    name = step.config.mirror_name if isinstance(step, DeltaStep) else step.table
    if not spark.catalog.tableExists(name):
        return math.inf
    plan = spark.table(name)._jdf.queryExecution().optimizedPlan()
    return float(str(plan.stats().sizeInBytes()))


def run_batch(
    spark: SparkSession, steps: Sequence[DeltaStep | PartitionStep], parallel: int = 4
) -> dict[str, object]:
    """Run the steps, ``parallel`` tables at a time; returns their results by table.

    The largest tables begin first, so that none of them is left for the end; tables that do not
    exist yet count as largest. Each runs in a scheduler pool of its own, named like the table:
    with ``spark.scheduler.mode=FAIR`` (``SETTINGS``) a small table need not wait for the tasks of
    a large one. A failing table does not stop the others. All failures are raised together.
    """
    names = [s.table.lower() for s in steps]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"more than one step for {', '.join(twice)}")
    done: dict[str, object] = {}
    errors: dict[str, Exception] = {}

    def in_pool(step: DeltaStep | PartitionStep) -> object:
        spark.sparkContext.setLocalProperty(POOL, step.table.lower())
        return step(spark)

    largest_first = sorted(steps, key=lambda step: -_size(spark, step))
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        target = inheritable_thread_target(spark)(in_pool)
        futures = {step.table: pool.submit(target, step) for step in largest_first}
    for table, future in futures.items():
        error = future.exception()
        if error is None:
            done[table] = future.result()
        else:
            errors[table] = error
    if errors:
        raise BatchFailed(errors, done)
    return done


def replay(
    spark: SparkSession, cfg: TableConfig, snapshots: Iterable[tuple[str, DataFrame]]
) -> list[BuildResult]:
    """Run the days in order; each is a job id and that day's snapshot."""
    results = []
    for job_id, snapshot in snapshots:
        results.append(build_delta(spark, replace(cfg, job_id=job_id), snapshot))
    return results
