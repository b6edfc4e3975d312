"""Link tables: hashes and pointers into a partitioned source history."""

from __future__ import annotations

from dataclasses import replace

import pytest
from conftest import plan
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changecapture import (
    ConfigError,
    TableConfig,
    add_partition,
    build_delta,
    create_landing,
    create_link,
    create_objects,
    land_partition,
    link_view_sql,
    swap_mirror,
    write_dataset,
    write_mirror,
)
from changecapture.config import version_name
from changecapture.tables import catalog

SCHEMA = "num int, part string, state string, created string"
PARTS = T.StructType([T.StructField(n, T.IntegerType()) for n in ("yy", "mn", "dy")])


@pytest.fixture
def table(spark, db, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    create_landing(spark, f"{db}.history_src", schema, f"{folder}/src", partitioned_by=PARTS)
    return f"{db}.history"


def land(spark, table, folder, day, rows):
    path = f"{folder}/src/yy=2024/mn=3/dy={day}"
    write_dataset(spark.createDataFrame(rows, SCHEMA), path)
    add_partition(spark, f"{table}_src", {"yy": 2024, "mn": 3, "dy": day}, path)


def settings(table, day, **more):
    return TableConfig(
        table,
        "num,part",
        exclusions="created,updated",
        partition_columns="yy,mn,dy",
        partition_values={"yy": 2024, "mn": 3, "dy": day},
        inline=False,
        job_id=f"day{day}",
        **more,
    )


DAYS = {
    5: [(1, "a", "x", "old"), (2, "b", "x", "old"), (3, "c", "x", "old"), (4, None, "x", "old")],
    6: [(1, "a", "x", "new"), (2, "b", "y", "new"), (4, None, "x", "new"), (5, "e", "x", "new")],
    7: [(1, "a", "z", "7"), (2, "b", "y", "7"), (3, "c", "x", "7"), (4, None, "x", "7")],
}


@pytest.mark.parametrize("table_type", ["dim", "fact"])
def test_pointers_follow_the_current_version(spark, table, folder, table_type):
    counts = {}
    for day, rows in DAYS.items():
        land(spark, table, folder, day, rows)
        result = build_delta(spark, settings(table, day, table_type=table_type))
        counts[day] = tuple(result.counts[a] for a in "IUDS")
        if day == 6:
            shown = sorted((r.num, r.state, r.created, r.dy) for r in spark.table(table).collect())
            # row 1 and 4 changed in an excluded column only: their old version stays current
            assert shown == [(1, "x", "old", 5), (2, "y", "new", 6), (4, "x", "old", 5),
                             (5, "x", "new", 6)]
    assert counts == {5: (4, 0, 0, 0), 6: (1, 1, 1, 2), 7: (1, 1, 1, 2)}
    shown = sorted((r.num, r.part, r.state, r.dy) for r in spark.table(table).collect())
    assert shown == [(1, "a", "z", 7), (2, "b", "y", 6), (3, "c", "x", 7), (4, None, "x", 5)]
    deleted = spark.table(f"{table}_delta").where("DWSACT = 'D'").collect()
    assert sorted((r.num, r.DWSJOB, r.yy, r.mn, r.dy) for r in deleted) == [
        (3, "day6", 2024, 3, 5), (5, "day7", 2024, 3, 6),
    ]


def test_link_columns(spark, table, folder):
    land(spark, table, folder, 5, DAYS[5])
    cfg = settings(table, 5)
    text = create_objects(spark, cfg)
    assert text.count(";") == 2 and "<=>" in text
    link = spark.table(f"{table}_nklink")
    lineage = ["NK", "DWSJOB", "DWSUNIACT", "DWSARCHIVE", "DWSKEYHASH", "DWSVALHASH"]
    assert link.columns == [*lineage, "num", "part", "yy", "mn", "dy"]
    assert [f.dataType.simpleString() for f in link.schema.fields[-5:]] == [
        "int", "string", "int", "int", "int",
    ]
    assert spark.table(table).columns == [*lineage, "num", "part", "state", "created", "yy", "mn", "dy"]
    assert build_delta(spark, cfg).delta.columns == [
        "NK", "DWSUNIACT", "DWSARCHIVE", "DWSACT", "DWSKEYHASH", "DWSVALHASH",
        "num", "part", "yy", "mn", "dy", "DWSJOB",
    ]


def _daily(spark, db, folder, days):
    """A history partitioned by ``export_date``, and settings that name no value."""
    schema = "id int, v string"
    create_landing(spark, f"{db}.t_src", spark.createDataFrame([], schema).schema, folder)
    for day, rows in days.items():
        path = land_partition(spark.createDataFrame(rows, schema), folder, day)
        add_partition(spark, f"{db}.t_src", {"export_date": day}, path)
    return TableConfig(f"{db}.t", "id", inline=False, job_id="d1")


def test_single_partition_column_defaults_to_the_job(spark, db, folder):
    days = {"d1": [(1, "a"), (2, "b"), (4, "x")], "d2": [(1, "a"), (2, "c"), (3, "d")]}
    cfg = _daily(spark, db, folder, days)
    build_delta(spark, cfg)
    result = build_delta(spark, replace(cfg, job_id="d2"))
    assert result.counts == {"I": 1, "U": 1, "D": 1, "S": 1}
    pointers = {r.id: r.export_date for r in result.mirror.collect()}
    assert pointers == {1: "d1", 2: "d2", 3: "d2"}
    shown = sorted((r.id, r.v) for r in spark.table(cfg.table).collect())
    assert shown == [(1, "a"), (2, "c"), (3, "d")]


def test_a_partition_setting_that_matches_nothing_is_refused(spark, db, folder):
    cfg = _daily(spark, db, folder, {"d1": [(1, "a")]})
    with pytest.raises(ConfigError, match="no partition column export_dt"):
        build_delta(spark, replace(cfg, partition_columns="export_dt"))
    inline = replace(cfg, inline=True, source_table=f"{db}.t_src", partition_columns="export_dt")
    with pytest.raises(ConfigError, match="no partition column export_dt"):
        build_delta(spark, replace(inline, partition_values="d1"))
    with pytest.raises(ConfigError, match="no value"):
        replace(cfg, partition_values={"export_date": None})


def test_a_link_needs_its_source_table(spark, db):
    cfg = TableConfig(f"{db}.t", "id", inline=False, job_id="d1")
    day = spark.createDataFrame([(1, "a")], "id int, v string")
    with pytest.raises(ConfigError, match="no source table"):
        build_delta(spark, cfg, day)


def test_a_missing_partition_value_keeps_its_rows(spark, db, folder):
    cfg = _daily(spark, db, folder, {"d1": [(1, "a")]})
    build_delta(spark, cfg)
    null = F.lit(None).cast("string").alias("export_date")
    spark.range(1).select(F.lit(2).alias("id"), F.lit("b").alias("v"), null).write.insertInto(
        f"{db}.t_src"
    )
    link = spark.table(version_name(cfg.mirror_name, "d1"))
    names = [c for c in link.columns if c not in ("id", "export_date")]
    lost = link.select(*names, F.lit(2).alias("id"), null)
    write_mirror(link.unionByName(lost), cfg.mirror_name, "dx")
    swap_mirror(spark, cfg.mirror_name, "dx")
    assert sorted((r.id, r.v) for r in spark.table(cfg.table).collect()) == [(1, "a"), (2, "b")]


def test_an_inline_table_has_no_link(spark, db):
    with pytest.raises(ConfigError):
        create_link(spark, TableConfig(f"{db}.t", "id"), spark.range(1).schema)


def test_view_needs_the_partition_columns(spark):
    cfg = TableConfig("t", "id", inline=False, partition_columns="yy", partition_values="1")
    with pytest.raises(ConfigError, match="yy"):
        link_view_sql(cfg, spark.range(1).schema)


def test_the_view_reads_only_partitions_in_use(spark, table, folder):
    """Thirty days of history, of which the rows of the link point to three."""
    for day in range(1, 31):
        rows = [(n, "a", f"{min(day, 10 * n)}", str(day)) for n in range(1, 4)]
        land(spark, table, folder, day, rows)
    for day in (5, 10, 20, 30):
        build_delta(spark, settings(table, day))
    shown = sorted((r.num, r.state, r.dy) for r in spark.table(table).collect())
    assert shown == [(1, "10", 10), (2, "20", 20), (3, "30", 30)]
    text = next(x for x in plan(spark.table(table)).split("\n\n") if "PartitionFilters" in x and "state" in x)
    assert "PartitionFilters: []" not in text and "dy" in text.split("PartitionFilters: ")[1].split("\n")[0]
    files = {f.split("dy=")[1].split("/")[0] for f in spark.table(table).inputFiles() if "/src/" in f}
    assert files == {"10", "20", "30"}


def test_the_view_holds_while_a_run_is_at_work(spark, table, folder, monkeypatch):
    """Right before and right after the switch the view shows whole versions."""
    land(spark, table, folder, 5, DAYS[5])
    land(spark, table, folder, 6, DAYS[6])
    build_delta(spark, settings(table, 5))
    seen, point = [], catalog.point_at

    def look(*args):
        seen.append(sorted((r.num, r.dy) for r in spark.table(table).collect()))
        point(*args)
        seen.append(sorted((r.num, r.dy) for r in spark.table(table).collect()))

    monkeypatch.setattr(catalog, "point_at", look)
    build_delta(spark, settings(table, 6))
    assert seen == [[(1, 5), (2, 5), (3, 5), (4, 5)], [(1, 5), (2, 6), (4, 5), (5, 6)]]


def test_a_broken_off_renewal_loses_nothing(spark, table, folder, monkeypatch):
    """The run stops between the switch and the last renewal; the view is whole, before and after."""
    for day in (5, 6, 7):
        land(spark, table, folder, day, DAYS[day])
    build_delta(spark, settings(table, 5))
    calls, renew = [], catalog.renew_link_view

    def once(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        renew(*args)

    monkeypatch.setattr(catalog, "renew_link_view", once)
    with pytest.raises(RuntimeError):
        build_delta(spark, settings(table, 6))
    want = [(1, 5), (2, 6), (4, 5), (5, 6)]
    assert sorted((r.num, r.dy) for r in spark.table(table).collect()) == want
    monkeypatch.setattr(catalog, "renew_link_view", renew)
    build_delta(spark, settings(table, 6))
    build_delta(spark, settings(table, 7))
    assert sorted((r.num, r.dy) for r in spark.table(table).collect()) == [(1, 7), (2, 6), (3, 7), (4, 5)]


def test_conditions_on_pointers():
    among = catalog._among
    assert among(["a"], []) == "false"
    assert among(["a"], [(1,), (2,)]) == "s.`a` IN (1, 2)"
    assert among(["a"], [("x'y",), (None,)]) == "s.`a` IN ('x\\'y') OR s.`a` IS NULL"
    assert among(["a", "b"], [(1, 2), (1, 3), (None, 4)]) == (
        "(s.`a` = 1 AND (s.`b` IN (2, 3))) OR (s.`a` IS NULL AND (s.`b` IN (4)))"
    )
