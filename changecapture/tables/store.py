"""Write datasets, delta and mirror tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changecapture import columns as C
from changecapture.config import ConfigError, version_name
from changecapture.functions.encoding import quoted
from changecapture.tables import catalog, parts
from changecapture.tables.names import identifier, partition_spec


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """Replace a directory with the rows of ``df``."""
    df.write.format(fmt).mode("overwrite").options(**options).save(path)


def append_delta(df: DataFrame, table: str, job_id: str) -> str:
    """Add one job's changes to ``<table>_delta``; returns that name.

    The job's partition is replaced as a whole, so repeating a job does not double it.
    Columns go by name. Rows are written by the tasks that read them: a run reads them from the
    version table, whose files are put together to splits of the session's size.
    """
    spark, name = df.sparkSession, f"{table}_delta"
    fields = [f for f in df.schema.fields if f.name != C.JOB]
    spark.sql(catalog.create_table_sql(name, [*fields, C.added_field(C.JOB)], C.JOB))
    spec = partition_spec({C.JOB: job_id})
    names = {f.name.lower(): f.name for f in fields}
    stored = [c for c in spark.table(name).columns if c != C.JOB]
    if sorted(names) != sorted(c.lower() for c in stored):
        raise ConfigError(f"{name}: columns {sorted(names)} do not match {sorted(stored)}")
    spark.sql(
        f"INSERT OVERWRITE TABLE {identifier(name)} PARTITION ({spec}) "
        f"SELECT {', '.join(quoted(names[c.lower()]) for c in stored)} FROM {{rows}}",
        rows=df,
    )
    # a job without changes leaves an empty partition: it has run
    catalog.add_partition(spark, name, {C.JOB: job_id})
    return name


def write_mirror(
    df: DataFrame,
    table: str,
    job_id: str,
    buckets: int | None = None,
    bucket_columns: Sequence[str] = (C.KEY_HASH,),
    rebalance: bool = False,
) -> str:
    """Write a full mirror as the version table ``<table>__<job>``; returns that name.

    Rows are partitioned by job and, where they still carry it, by label: a classified
    set written this way serves both as the new mirror (labels but ``D``) and as the
    source of the delta (labels but ``S``), and each reads only its own directories.

    ``rebalance`` gathers the rows of a job before writing. Without it every task
    writes a file per job it meets, which is too many once a fact table has a long
    history. Jobs that hold much of the table are split over several tasks.
    """
    spark, version = df.sparkSession, version_name(table, job_id)
    by = [c for c in (C.JOB, C.ACT) if c in df.columns]
    if rebalance:
        df = df.hint("rebalance", *by)
    writer = df.write.format(catalog.FORMAT).mode("overwrite").partitionBy(*by)
    writer = writer.options(**catalog.storage_options(df.columns))
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_columns)
    writer.saveAsTable(version)
    catalog.refresh(spark, version)
    return version


def swap_mirror(spark: SparkSession, table: str, job_id: str) -> str:
    """Let ``<table>`` show the version written by a job; drop the one before the last.

    The switch is a single replacement of a view: no row is copied, and a query planned on
    the version before still finds its files until the next switch.

    The view over a link table names the source partitions in use. It is renewed before the
    switch to name those of both versions, and after it to name those of the new one alone.
    """
    version = version_name(table, job_id)
    now = catalog.versions(spark, table)
    link = catalog.linked(spark, table)
    if link:
        rows = spark.table(version)
        rows = rows.where(F.col(C.ACT) != C.DELETE) if C.ACT in rows.columns else rows
        live = catalog.live_pointers(rows, link["partitions"])
        before = catalog.live_pointers(spark.table(table), link["partitions"]) if now else []
        catalog.renew_link_view(spark, link, live + before)
    if now is None:
        catalog.point_at(spark, table, version)
    elif now.current != version:
        catalog.point_at(spark, table, version, now.current, now.previous)
    if link:
        catalog.renew_link_view(spark, link, live)
    drop_outdated(spark, table)
    return version


def drop_outdated(spark: SparkSession, table: str) -> None:
    """Drop the version table that neither the mirror nor its last readers need."""
    now = catalog.versions(spark, table)
    if now and now.outdated:
        parts.drop_version(spark, table, now.outdated, (now.current, now.previous))
        catalog.mark(spark, table, catalog.OUTDATED, None)
