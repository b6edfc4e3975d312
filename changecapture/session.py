"""Where intermediate tables go, and session settings the jobs are written for."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from changecapture.tables.names import literal

# Settings of the engine itself that suit these jobs at any scale. Sizes (memory,
# cores, shuffle partitions) depend on the cluster and are left to the caller.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # each task writes at most a few partition directories (job x label): keep their
    # files open side by side instead of sorting the wide rows by directory first
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # tables of a batch share the executors evenly instead of first come, first served
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
}


def work_folder(spark: SparkSession) -> str:
    """New folder all executors can reach.

    It lies below ``spark.checkpoint.dir``, below the checkpoint folder the session was given
    otherwise, or else in the warehouse.
    """
    base = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    return f"{base.rstrip('/')}/changecapture-{uuid.uuid4().hex[:12]}"


def work_database(spark: SparkSession, folder: str | None = None) -> str:
    """New database whose tables lie in a shared folder."""
    folder = folder or work_folder(spark)
    name = f"cc_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION {literal(f'{folder}/{name}.db')}")
    return name


def drop_work_databases(spark: SparkSession) -> None:
    """Drop what ``work_database`` made in this session, tables and all.

    Results of queries read these tables, so this is for the end of a session.
    """
    for row in spark.sql("SHOW DATABASES LIKE 'cc_*'").collect():
        spark.sql(f"DROP DATABASE IF EXISTS {row[0]} CASCADE")
