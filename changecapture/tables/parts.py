"""Versions of a mirror that share files: copy on write by job partition.

A version is a table over directories, one for each job and label. A directory whose rows no
later job touched is not written again: the next version registers it by its location. Which
directories a version is made of is its *manifest*, a small dataset beside the files. When a
version goes, only directories that no other version's manifest names are deleted.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changecapture import columns as C
from changecapture.functions.encoding import quoted
from changecapture.tables import catalog
from changecapture.tables.names import identifier, literal, partition_folder

_MANIFEST = "job string, act string, path string"


@dataclass(frozen=True)
class Part:
    """A directory of rows that one job wrote, and their label in a version."""

    job: str
    act: str
    path: str


def files_root(spark: SparkSession, mirror: str) -> str:
    """Folder of the files of all versions of a mirror, beside the tables of its database."""
    *database, table = mirror.split(".")
    name = ".".join(database) or spark.catalog.currentDatabase()
    location = spark.sql(f"DESCRIBE DATABASE {identifier(name)}")
    row = location.where(F.col("info_name") == "Location").first()
    return f"{row['info_value'].rstrip('/')}/{table.lower()}__files"


def _folder(spark: SparkSession, mirror: str, version: str, kind: str = "rows") -> str:
    return f"{files_root(spark, mirror)}/{kind}/{version.split('.')[-1]}"


def hadoop_path(spark: SparkSession, path: str):
    """Hadoop path and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _delete(spark: SparkSession, path: str) -> None:
    found, files = hadoop_path(spark, path)
    files.delete(found, True)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a dataset was written to its end."""
    found, files = hadoop_path(spark, f"{path}/_SUCCESS")
    return files.exists(found)


def manifest(spark: SparkSession, mirror: str, version: str) -> list[Part] | None:
    """Directories of a version, as many as it has jobs and labels; None if it has no manifest."""
    path = _folder(spark, mirror, version, "manifest")
    if not _exists(spark, path):
        return None
    return [Part(*r) for r in spark.read.schema(_MANIFEST).orc(path).collect()]


def untouched(parts: Iterable[Part], touched: set[str]) -> list[Part]:
    """Directories the next version takes over as they are, their rows being stationary now.

    A job that still has two directories (what it inserted, what it updated) is not among them:
    a version has one place for the stationary rows of a job.
    """
    kept = [p for p in parts if p.act != C.DELETE]
    jobs = [p.job for p in kept]
    return [
        Part(p.job, C.STATIONARY, p.path)
        for p in kept
        if p.job not in touched and jobs.count(p.job) == 1
    ]


def write_version(
    rows: DataFrame, mirror: str, version: str, carried: Iterable[Part] = ()
) -> str:
    """Write rows as new directories of a version, and register those carried over.

    The table is external: dropping it leaves the files to ``drop_version``.
    """
    spark, path = rows.sparkSession, _folder(rows.sparkSession, mirror, version)
    _delete(spark, _folder(spark, mirror, version, "manifest"))
    spark.sql(f"DROP TABLE IF EXISTS {identifier(version)}")
    options = catalog.storage_options(rows.columns)
    (
        rows.hint("rebalance", C.JOB, C.ACT)
        .write.format(catalog.FORMAT)
        .mode("overwrite")
        .options(**options)
        .partitionBy(C.JOB, C.ACT)
        .save(path)
    )
    labels = T.StructType([T.StructField(n, T.StringType()) for n in (C.JOB, C.ACT)])
    fields = [f for f in rows.schema.fields if f.name not in (C.JOB, C.ACT)]
    own = spark.read.schema(T.StructType([*fields, *labels])).format(catalog.FORMAT).load(path)
    parts = [
        Part(job, act, f"{path}/{partition_folder(C.JOB, job)}/{partition_folder(C.ACT, act)}")
        for job, act in own.select(C.JOB, C.ACT).distinct().collect()
    ]
    parts += list(carried)
    spark.sql(
        f"CREATE TABLE {identifier(version)} ({catalog.column_list([*fields, *labels])}) "
        f"USING {catalog.FORMAT} PARTITIONED BY ({quoted(C.JOB)}, {quoted(C.ACT)}) "
        f"LOCATION {literal(path)}"
    )
    catalog.add_partitions(
        spark, version, [({C.JOB: p.job, C.ACT: p.act}, p.path) for p in parts]
    )
    listed = spark.createDataFrame([(p.job, p.act, p.path) for p in parts], _MANIFEST)
    listed.coalesce(1).write.format(catalog.FORMAT).mode("overwrite").save(
        _folder(spark, mirror, version, "manifest")
    )
    return version


def drop_version(spark: SparkSession, mirror: str, version: str, others: Iterable[str]) -> None:
    """Drop a version and the directories that none of the ``others`` is made of.

    The manifest goes last, so that a drop that broke off can be repeated.
    """
    own = manifest(spark, mirror, version)
    spark.sql(f"DROP TABLE IF EXISTS {identifier(version)}")
    if own is not None:
        used = {p.path for v in others if v for p in manifest(spark, mirror, v) or ()}
        for part in own:
            if part.path not in used:
                _delete(spark, part.path)
    folder = _folder(spark, mirror, version)
    if own is None:
        # it broke off before its manifest: nobody else knows its directories
        _delete(spark, folder)
    _delete(spark, _folder(spark, mirror, version, "digests"))
    _delete(spark, _folder(spark, mirror, version, "manifest"))


# -- digests of buckets ---------------------------------------------------------------


def write_digests(rows: DataFrame, mirror: str, version: str, buckets: int) -> None:
    """Store digests with a version; how many buckets they are of is part of the place."""
    path = f"{_folder(rows.sparkSession, mirror, version, 'digests')}/{buckets}"
    rows.coalesce(1).write.format(catalog.FORMAT).mode("overwrite").save(path)


def read_digests(
    spark: SparkSession, mirror: str, version: str, buckets: int
) -> DataFrame | None:
    """Digests stored with a version; None if it has none for so many buckets."""
    path = f"{_folder(spark, mirror, version, 'digests')}/{buckets}"
    return spark.read.format(catalog.FORMAT).load(path) if _exists(spark, path) else None
