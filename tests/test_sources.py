from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from changecapture import (
    ingest_jdbc,
    land_partition,
    read_jdbc,
    read_landing,
    read_snapshot,
    read_table,
    write_dataset,
)
from changecapture.session import work_folder
from changecapture.tables.names import partition_folder


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_dataset_round_trip_replaces(spark, folder, fmt):
    write_dataset(spark.range(9), folder, fmt)
    write_dataset(spark.range(3), folder, fmt)
    assert sorted(r.id for r in read_snapshot(spark, folder, fmt).collect()) == [0, 1, 2]


def test_avro_is_asked_for_only_when_used(spark, folder):
    with pytest.raises(AnalysisException, match="(?i)avro"):
        read_snapshot(spark, folder, "avro")


def test_landing_replaces_one_day(spark, folder):
    land_partition(spark.range(3), folder, "2024-01-01")
    land_partition(spark.range(5), folder, "2024-01-02")
    land_partition(spark.range(2), folder, "2024-01-01")
    one, two = (read_landing(spark, folder, f"2024-01-0{d}") for d in (1, 2))
    assert (one.count(), two.count()) == (2, 5)
    assert dict(one.dtypes)["export_date"] == "string"
    land_partition(spark.range(5).where(F.lit(False)), folder, "2024-01-02")
    assert read_landing(spark, folder, "2024-01-02").count() == 0
    assert read_landing(spark, folder, "2024-01-01").count() == 2


@pytest.mark.parametrize("value", ["007", "05-12-2020", "a b", "x=y/z", "50%"])
def test_partition_values_are_kept_as_given(spark, folder, value):
    land_partition(spark.range(1), folder, value)
    assert read_landing(spark, folder, value).first().export_date == value
    # the directory name is the one Spark itself writes and reads
    df = spark.range(1).withColumn("k", F.lit(value))
    df.write.mode("overwrite").partitionBy("k").parquet(f"{folder}/spark")
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/spark")
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(jvm_path)]
    assert partition_folder("k", value) in names


def test_landed_compression(spark, folder):
    path = land_partition(spark.range(1), folder, "d", compression="gzip")
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert any(".gz." in s.getPath().getName() for s in fs.listStatus(jvm_path))


def test_missing_table_is_an_error(spark):
    with pytest.raises(AnalysisException):
        read_table(spark, "no_such_table").count()


class FakeReader:
    """Stands in for ``spark.read``: notes the calls and hands out rows."""

    def __init__(self, spark, bounds=(1, 100)):
        self.spark, self.bounds, self.calls = spark, bounds, []
        self.read = self

    def jdbc(self, url, table, **options):
        self.calls.append((table, options))
        if table.endswith("bounds"):
            return self.spark.createDataFrame([self.bounds], "lo int, hi int")
        return self.spark.range(4)


def test_jdbc_extract_is_split_over_the_range_of_a_column(spark):
    reader = FakeReader(spark)
    read_jdbc(reader, "jdbc:x", "t", {"user": "u"}, split_column="id", splits=8)
    (bounds, _), (table, options) = reader.calls
    assert bounds == "(select min(id) lo, max(id) hi from t) bounds"
    assert table == "t"
    assert options == {
        "column": "id",
        "lowerBound": "1",
        "upperBound": "100",
        "numPartitions": 8,
        "properties": {"user": "u"},
    }


def test_jdbc_extract_unsplit_empty_or_by_conditions(spark):
    reader = FakeReader(spark, bounds=(None, None))
    read_jdbc(reader, "jdbc:x", "t", {}, split_column="id", splits=8)
    assert reader.calls[-1] == ("t", {"properties": {}})
    read_jdbc(reader, "jdbc:x", "t", {}, splits=1)
    assert reader.calls[-1] == ("t", {"properties": {}})
    with pytest.raises(ValueError, match="splits=1"):
        read_jdbc(reader, "jdbc:x", "t", {})
    with pytest.raises(ValueError, match="split_column"):
        read_jdbc(reader, "jdbc:x", "t", {}, splits=8)
    read_jdbc(reader, "jdbc:x", "t", {}, predicates=["id < 5", "id >= 5 or id is null"])
    assert reader.calls[-1][1]["predicates"] == ["id < 5", "id >= 5 or id is null"]


def test_jdbc_ingest_lands_the_extract(spark, folder):
    path = ingest_jdbc(FakeReader(spark), "jdbc:x", "t", {}, folder, "2024-01-01", splits=1)
    assert path.endswith("/export_date=2024-01-01")
    assert read_landing(spark, folder, "2024-01-01").count() == 4


def test_work_folder_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = work_folder(spark), work_folder(spark)
    assert one != two and one.startswith(f"{base}/")


def test_work_goes_to_the_warehouse_if_no_folder_is_named():
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, *none: {"spark.sql.warehouse.dir": "/w"}.get(key))

        class sparkContext:  # noqa: N801
            getCheckpointDir = staticmethod(lambda: None)  # noqa: N815

    assert work_folder(Session).startswith("/w/changecapture-")
