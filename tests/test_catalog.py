from __future__ import annotations

import pytest

from changecapture import (
    TableConfig,
    add_partition,
    add_partitions,
    append_delta,
    create_landing,
    create_mirror,
    drop_partition,
    land_partition,
    list_partitions,
    mirror_ddl,
    swap_mirror,
    write_mirror,
)
from changecapture.tables.catalog import versions


def test_mirror_ddl(spark):
    schema = spark.createDataFrame([], "ID int, T1 string").schema
    assert mirror_ddl(TableConfig("db.t", "id"), schema) == (
        "CREATE TABLE IF NOT EXISTS `db`.`t__init` (`NK` string, `DWSUNIACT` string, "
        "`DWSARCHIVE` string, `DWSKEYHASH` string, `DWSVALHASH` string, `ID` int, `T1` string, "
        "`DWSJOB` string) USING orc "
        "OPTIONS ('orc.column.encoding.direct' = 'NK,DWSKEYHASH,DWSVALHASH') "
        "PARTITIONED BY (`DWSJOB`)"
    )
    fact = mirror_ddl(TableConfig("t", "id", table_type="fact"), schema)
    assert "`DWSAUTO` string, `DWSARCHIVE` string" in fact and "`NK`" not in fact


def test_create_mirror_leaves_an_existing_one_alone(spark, db):
    cfg = TableConfig(f"{db}.t", "id")
    schema = spark.createDataFrame([], "id int").schema
    create_mirror(spark, cfg, schema)
    row = spark.createDataFrame([("n", None, "N", "k", "v", 1, "j")], spark.table(
        f"{db}.t__init").schema)
    write_mirror(row, cfg.table, "j")
    swap_mirror(spark, cfg.table, "j")
    create_mirror(spark, cfg, schema)
    assert spark.table(cfg.table).count() == 1
    assert spark.table(cfg.table).columns == [
        "NK", "DWSJOB", "DWSUNIACT", "DWSARCHIVE", "DWSKEYHASH", "DWSVALHASH", "id",
    ]
    assert versions(spark, cfg.table).previous == f"{db}.t__init"


def test_swap_switches_versions_and_can_be_repeated(spark, db):
    table = f"{db}.m"
    for job in ("a", "b", "c"):
        rows = spark.createDataFrame(
            [("k", "v", job, job)], "DWSKEYHASH string, DWSVALHASH string, x string, DWSJOB string"
        )
        write_mirror(rows, table, job)
        for _ in range(2):
            swap_mirror(spark, table, job)
        assert [r.x for r in spark.table(table).collect()] == [job]
    now = versions(spark, table)
    assert (now.current, now.previous, now.outdated) == (f"{table}__c", f"{table}__b", None)
    assert spark.catalog.tableExists(f"{table}__b")
    assert not spark.catalog.tableExists(f"{table}__a")


def test_delta_of_a_job_is_replaced_and_of_other_jobs_kept(spark, db):
    def rows(*values):
        return spark.createDataFrame([(v, "I", "x") for v in values], "id int, DWSACT string, "
                                     "DWSJOB string")

    append_delta(rows(1, 2), f"{db}.t", "a")
    append_delta(rows(3), f"{db}.t", "b")
    name = append_delta(rows(4), f"{db}.t", "a")
    assert sorted((r.id, r.DWSJOB) for r in spark.table(name).collect()) == [(3, "b"), (4, "a")]
    append_delta(rows(9).where("id < 0"), f"{db}.t", "it's")
    assert "DWSJOB=it%27s" in {r[0] for r in list_partitions(spark, name).collect()}


def test_partitions_are_registered_once_and_dropped(spark, db, folder):
    table = f"{db}.landing"
    schema = spark.range(1).schema
    create_landing(spark, table, schema, folder)
    paths = {d: land_partition(spark.range(n), folder, d) for d, n in (("d1", 2), ("d2", 3))}
    assert spark.table(table).count() == 0
    for _ in range(2):
        add_partition(spark, table, {"export_date": "d1"}, paths["d1"])
    assert spark.table(table).count() == 2
    add_partitions(spark, table, [({"export_date": d}, p) for d, p in paths.items()])
    assert spark.table(table).count() == 5
    assert list_partitions(spark, table).count() == 2
    for _ in range(2):
        drop_partition(spark, table, {"export_date": "d1"})
    assert spark.table(table).count() == 3
    add_partition(spark, table, {"export_date": "d1"}, paths["d1"])
    assert spark.table(table).count() == 5  # dropping it left the files


def test_a_directory_elsewhere_can_be_a_partition(spark, db, folder):
    path = land_partition(spark.range(4), f"{folder}/daily", "job-7", column="partition")
    create_landing(spark, f"{db}.copied", spark.range(1).schema, f"{folder}/copied",
                   partitioned_by="PARTITION")
    for _ in range(2):
        add_partition(spark, f"{db}.copied", {"PARTITION": "job-7"}, path)
    assert spark.table(f"{db}.copied").count() == 4


@pytest.mark.parametrize("value", ["it's", "a\\b", 'q"r'])
def test_partition_values_are_escaped(spark, db, folder, value):
    create_landing(spark, f"{db}.esc", spark.range(1).schema, folder)
    path = land_partition(spark.range(2), folder, value)
    add_partition(spark, f"{db}.esc", {"export_date": value}, path)
    assert [r.export_date for r in spark.table(f"{db}.esc").collect()] == [value, value]
