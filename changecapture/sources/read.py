"""Read snapshots, landed partitions and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changecapture.tables.names import partition_folder


def read_snapshot(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Load a snapshot directory. ``avro`` needs Spark's avro module on the class path."""
    return spark.read.format(fmt).options(**options).load(path)


def read_landing(
    spark: SparkSession,
    root: str,
    value: str,
    fmt: str = "parquet",
    column: str = "export_date",
) -> DataFrame:
    """Load one landed day, with the partition column as text.

    Only that day's directory is listed, however long the history is, and the value is
    taken as given instead of being guessed to be a date or a number.
    """
    folder = f"{root.rstrip('/')}/{partition_folder(column, value)}"
    return read_snapshot(spark, folder, fmt).withColumn(column, F.lit(value))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Rows of a catalog table or view; raises if there is none."""
    return spark.table(name)
