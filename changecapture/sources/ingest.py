"""Bring operational tables to the landing zone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from changecapture.tables.names import partition_folder


def land_partition(
    df: DataFrame,
    root: str,
    value: str,
    fmt: str = "parquet",
    column: str = "export_date",
    compression: str | None = None,
) -> str:
    """Replace one day's directory under ``root``; returns its path.

    Landing a day again replaces it, also when the new extract is empty. Other days are
    not touched or even listed.
    """
    folder = f"{root.rstrip('/')}/{partition_folder(column, value)}"
    kept = [c for c in df.columns if c.lower() != column.lower()]
    writer = df.select(*kept).write.format(fmt).mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    writer.save(folder)
    return folder


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    split_column: str | None = None,
    splits: int | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Full extract of a database table, read by ``splits`` tasks.

    The caller says how the read is cut: a ``split_column`` with ``splits``, or
    ``predicates``. A table that one task should read takes ``splits=1``.

    ``split_column`` is a numeric, date or timestamp column; its range is asked of the
    database first and cut into equal strides. Where the values are uneven, give
    ``predicates`` instead: one condition per task, together covering every row once.
    """
    props = dict(properties)
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    if splits is None or (splits > 1 and not split_column):
        raise ValueError(f"{table}: give split_column and splits, predicates, or splits=1")
    if splits <= 1:
        return spark.read.jdbc(url, table, properties=props)
    query = f"(select min({split_column}) lo, max({split_column}) hi from {table}) bounds"
    low, high = spark.read.jdbc(url, query, properties=props).first()
    if low is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(
        url,
        table,
        column=split_column,
        lowerBound=str(low),
        upperBound=str(high),
        numPartitions=splits,
        properties=props,
    )


def ingest_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    root: str,
    value: str,
    fmt: str = "parquet",
    column: str = "export_date",
    compression: str | None = None,
    **split,
) -> str:
    """Extract a database table and land it as one day; returns the day's path.

    Connection properties (user, password, driver, fetchsize) come from the caller.
    """
    df = read_jdbc(spark, url, table, properties, **split)
    return land_partition(df, root, value, fmt, column, compression)
