"""Land a day in the layout of its mirror."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changecapture.config import ConfigError, TableConfig
from changecapture.functions.hashing import match_columns
from changecapture.plans.build import hash_source
from changecapture.tables import catalog


def land_hashed(
    spark: SparkSession, cfg: TableConfig, snapshot: DataFrame, table: str | None = None
) -> str:
    """Land a snapshot hashed, in the buckets of its mirror; returns the table's name.

    The shuffle that a run needs is paid where the day lands: ``build_delta`` takes the rows of
    this table as ``hashed`` and joins them with the mirror bucket by bucket, without an exchange
    on either side. The table is ``<table>_landed`` unless named; landing again replaces the day.
    """
    if not cfg.buckets:
        raise ConfigError(f"{cfg.table}: land_hashed needs buckets")
    name = table or f"{cfg.table}_landed"
    hashed = hash_source(snapshot, cfg)
    match = match_columns(cfg, hashed)
    writer = hashed.repartition(cfg.buckets, *match).write.format(catalog.FORMAT)
    writer = writer.mode("overwrite").options(**catalog.storage_options(hashed.columns))
    writer.bucketBy(cfg.buckets, *match).sortBy(*match).saveAsTable(name)
    catalog.refresh(spark, name)
    return name
