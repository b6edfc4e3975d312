"""Repeating, repairing and refusing runs; storage options."""

from __future__ import annotations

from dataclasses import replace

import pytest
from conftest import plan
from pyspark.sql import functions as F

from changecapture import (
    ConfigError,
    DuplicateKeys,
    JobAlreadyFinished,
    TableConfig,
    add_hashes,
    build_delta,
    classify,
    list_partitions,
    run,
    write_dataset,
    write_mirror,
)
from changecapture.config import version_name
from changecapture.operators.classify import changed_keys, classify_changed, ranked
from changecapture.plans import build
from changecapture.tables import store

SCHEMA = "id int, v string"


def frame(spark, text):
    """'1a 2b' is two rows."""
    return spark.createDataFrame([(int(t[:-1]), t[-1]) for t in text.split()], SCHEMA)


def shown(df):
    return sorted(f"{r.id}{r.v}" for r in df.collect())


@pytest.fixture
def cfg(db):
    return TableConfig(f"{db}.t", "id", job_id="d1")


def test_repeating_a_finished_job_changes_nothing(spark, cfg):
    build_delta(spark, cfg, frame(spark, "1a 2b"))
    second = replace(cfg, job_id="d2")
    one = build_delta(spark, second, frame(spark, "1x 3c"))
    again = build_delta(spark, second, frame(spark, "9z"))
    assert again.counts == one.counts == {"I": 1, "U": 1, "D": 1, "S": 0}
    assert shown(again.mirror) == ["1x", "3c"]
    assert spark.table(cfg.delta_name).count() == 5


@pytest.mark.parametrize("step", ["append_delta", "swap_mirror", "drop_outdated"])
def test_a_broken_off_run_is_repaired_by_running_it_again(spark, cfg, monkeypatch, step):
    build_delta(spark, cfg, frame(spark, "1a 2b"))
    second = replace(cfg, job_id="d2")
    with monkeypatch.context() as broken:
        broken.setattr(store, step, lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            build_delta(spark, second, frame(spark, "1x 3c"))
    if step != "drop_outdated":
        assert shown(spark.table(cfg.table)) == ["1a", "2b"]
    result = build_delta(spark, second, frame(spark, "1x 3c"))
    assert result.counts == {"I": 1, "U": 1, "D": 1, "S": 0}
    assert shown(result.mirror) == ["1x", "3c"]
    assert spark.table(cfg.delta_name).count() == 5
    # the version before stays for its readers, the one before that goes
    assert spark.catalog.tableExists(version_name(cfg.table, "d1"))
    assert not spark.catalog.tableExists(version_name(cfg.table, "init"))


def test_jobs_before_the_last_are_refused_after_a_run_that_broke_off(spark, cfg, monkeypatch):
    build_delta(spark, cfg, frame(spark, "1a 2b"))
    with monkeypatch.context() as broken:
        broken.setattr(store, "drop_outdated", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.swap_mirror(spark, cfg.table, "d1")
    second, third = replace(cfg, job_id="d2"), replace(cfg, job_id="d3")
    build_delta(spark, second, frame(spark, "1x 3c"))
    build_delta(spark, third, frame(spark, "1y 3c"))
    for job in (cfg, second):
        with pytest.raises(JobAlreadyFinished):
            build_delta(spark, job, frame(spark, "9z"))
    assert shown(spark.table(cfg.table)) == ["1y", "3c"]
    assert not spark.catalog.tableExists(version_name(cfg.table, "d1"))


def test_the_next_job_undoes_one_that_broke_off_before_its_switch(spark, cfg, monkeypatch):
    build_delta(spark, cfg, frame(spark, "1a 2b"))
    second, third = replace(cfg, job_id="d2"), replace(cfg, job_id="d3")
    with monkeypatch.context() as broken:
        broken.setattr(store, "swap_mirror", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            build_delta(spark, second, frame(spark, "1x 3c"))
    result = build_delta(spark, third, frame(spark, "1y 2b"))
    assert result.counts == {"I": 0, "U": 1, "D": 0, "S": 1}
    assert not spark.catalog.tableExists(version_name(cfg.table, "d2"))
    parts = sorted(r[0] for r in list_partitions(spark, cfg.delta_name).collect())
    assert parts == ["DWSJOB=d1", "DWSJOB=d3"]


def test_readers_of_the_version_before_can_finish(spark, cfg):
    build_delta(spark, cfg, frame(spark, "1a 2b"))
    reading = spark.table(cfg.table)
    build_delta(spark, replace(cfg, job_id="d2"), frame(spark, "1x"))
    assert reading.count() == 2


def test_columns_may_come_in_any_order(spark, db):
    cfg = TableConfig(f"{db}.o", "k1,k2", job_id="d1")
    schema = "k1 string, k2 string, name string, city string"
    day = spark.createDataFrame([("a", "b", "alice", "paris"), ("c", "d", "bob", "rome")], schema)
    first = {r.k1: r.NK for r in build_delta(spark, cfg, day).mirror.collect()}
    moved = day.select("city", "k2", "name", "k1")
    result = build_delta(spark, replace(cfg, job_id="d2"), moved)
    assert result.counts == {"I": 0, "U": 0, "D": 0, "S": 2}
    assert {r.k1: r.NK for r in result.mirror.collect()} == first
    changed = moved.withColumn("city", F.when(F.col("k1") == "a", "oslo").otherwise(F.col("city")))
    result = build_delta(spark, replace(cfg, job_id="d3"), changed)
    (row,) = result.delta.collect()
    assert (row.k1, row.k2, row.name, row.city, row.NK) == ("a", "b", "alice", "oslo", first["a"])


def test_a_lost_column_is_refused_before_anything_is_written(spark, cfg):
    wide = frame(spark, "1a").withColumn("w", F.lit(1))
    build_delta(spark, cfg, wide)
    with pytest.raises(ConfigError, match="no column w"):
        build_delta(spark, replace(cfg, job_id="d2"), frame(spark, "1a"))
    assert not spark.catalog.tableExists(version_name(cfg.table, "d2"))


@pytest.mark.parametrize("kind", ["murmur", "xxhash"])
def test_values_under_one_short_hash_are_told_apart(spark, db, kind):
    found = spark.range(300_000).select(F.col("id").cast("string").alias("v"))
    encoded = F.concat(F.length("v").cast("string"), F.lit(":"), F.col("v"))
    if kind == "murmur":  # two values with the same 32 bits
        twins = found.groupBy(F.hash(encoded).alias("h")).agg(F.min("v").alias("a"), F.max("v").alias("b"))
        one, two = twins.where("a <> b").orderBy("h").select("a", "b").first()
    else:
        one, two = "x", "y"
    cfg = TableConfig(f"{db}.h", "id", hash_kind=kind, job_id="d1")
    build_delta(spark, cfg, spark.createDataFrame([(1, one)], "id int, v string"))
    result = build_delta(
        spark, replace(cfg, job_id="d2"), spark.createDataFrame([(1, two)], "id int, v string")
    )
    assert result.counts == {"I": 0, "U": 1, "D": 0, "S": 0}


def test_the_check_for_copies_needs_no_shuffle_of_its_own(spark, db):
    cfg = TableConfig(f"{db}.x", "id", job_id="d1")
    rows = spark.range(500).select("id", F.lit("a").alias("v"))
    mirror = build_delta(spark, cfg, rows).mirror
    hashed = add_hashes(rows, replace(cfg, job_id="d2"))
    both = [ranked(side, ["DWSKEYHASH"]) for side in (hashed, mirror)]
    text = plan(classify(*both, replace(cfg, job_id="d2")), "simple")
    assert text.count("Exchange hashpartitioning") == 2


def test_a_job_cannot_be_named_like_the_empty_mirror():
    with pytest.raises(ConfigError, match="init"):
        TableConfig("t", "id", job_id="init")


def test_a_job_of_the_past_is_refused(spark, cfg):
    for job, rows in (("d1", "1a"), ("d2", "1a"), ("d3", "1b")):
        build_delta(spark, replace(cfg, job_id=job), frame(spark, rows))
    for job in ("d1", "d2"):  # d2 had no changes; it counts as run all the same
        with pytest.raises(JobAlreadyFinished):
            build_delta(spark, replace(cfg, job_id=job), frame(spark, "7g"))
    parts = sorted(r[0] for r in list_partitions(spark, cfg.delta_name).collect())
    assert parts == ["DWSJOB=d1", "DWSJOB=d2", "DWSJOB=d3"]


def test_duplicate_keys_stop_a_run_before_it_writes(spark, cfg):
    build_delta(spark, cfg, frame(spark, "1a"))
    with pytest.raises(DuplicateKeys, match="1 keys"):
        build_delta(spark, replace(cfg, job_id="d2"), frame(spark, "1a 2b 2c"))
    assert shown(spark.table(cfg.table)) == ["1a"]
    assert not spark.catalog.tableExists(version_name(cfg.table, "d2"))


def test_duplicate_keys_can_be_dropped_by_order(spark, db, cfg):
    first = replace(cfg, on_duplicates="keep_first", dedupe_order="v")
    build_delta(spark, first, frame(spark, "1b 1a 2z 2y 2z"))
    assert shown(spark.table(cfg.table)) == ["1a", "2y"]
    result = build_delta(spark, replace(first, job_id="d2"), frame(spark, "1a 1a 2x 2y"))
    assert result.counts == {"I": 0, "U": 1, "D": 0, "S": 1}


def test_a_key_with_a_third_of_all_rows(spark, db):
    """Counting and dropping copies of a hot key needs no task that sees them all."""
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("id"),
        F.col("id").cast("string").alias("v"),
    )
    rows = rows.where("id <> 7").unionByName(rows.where("id = 7")).repartition(6)
    cfg = TableConfig(f"{db}.hot", "id", job_id="d1")
    with pytest.raises(DuplicateKeys, match="1 keys"):
        build_delta(spark, cfg, rows)
    kept = replace(cfg, on_duplicates="keep_first", dedupe_order="v")
    result = build_delta(spark, kept, rows)
    assert result.counts["I"] == rows.select("id").distinct().count()
    assert result.mirror.where("id = 7").first().v == "0"


def test_a_mirror_that_does_not_fit_the_snapshot_is_refused(spark, cfg):
    build_delta(spark, cfg, frame(spark, "1a"))
    second = replace(cfg, job_id="d2")
    with pytest.raises(ConfigError, match="no column w"):
        build_delta(spark, second, frame(spark, "1a").withColumn("w", F.lit(1)))
    with pytest.raises(ConfigError, match="is bigint in the snapshot"):
        build_delta(spark, second, frame(spark, "1a").withColumn("id", F.lit(1).cast("bigint")))


def test_a_table_that_is_not_a_mirror_is_refused(spark, cfg):
    frame(spark, "1a").write.saveAsTable(cfg.table)
    with pytest.raises(ConfigError, match="not a mirror"):
        build_delta(spark, cfg, frame(spark, "1a"))


def test_a_mirror_with_duplicate_keys_stops_the_run(spark, cfg):
    build_delta(spark, cfg, frame(spark, "1a 2b"))
    version = version_name(cfg.table, "d1")
    double = spark.table(version).collect()
    spark.createDataFrame(double, spark.table(version).schema).write.insertInto(version)
    with pytest.raises(build.BrokenMirror):
        build_delta(spark, replace(cfg, job_id="d2"), frame(spark, "1a 2b"))
    assert spark.table(cfg.delta_name).where("DWSJOB = 'd2'").count() == 0


@pytest.mark.parametrize("kind", ["md5", "murmur"])
def test_buckets_save_the_shuffle_of_the_mirror(spark, db, kind):
    cfg = TableConfig(f"{db}.b", "id", buckets=4, hash_kind=kind, job_id="d1")
    rows = spark.range(2000).select(F.col("id").cast("int"), F.lit("a").alias("v"))
    build_delta(spark, cfg, rows)
    second = replace(cfg, job_id="d2")
    changed = rows.where("id > 9").withColumn("v", F.expr("if(id < 30, 'b', v)"))
    result = build_delta(spark, second, changed)
    assert result.counts == {"I": 0, "U": 20, "D": 10, "S": 1970}
    again = build_delta(spark, replace(cfg, job_id="d3"), rows)
    assert again.counts == {"I": 10, "U": 20, "D": 0, "S": 1970}
    if kind == "md5":
        text = plan(classify(add_hashes(changed, second), again.mirror, second), "simple")
        assert text.count("Exchange") == 1
        assert "Bucketed: true" in text


@pytest.mark.parametrize("table_type", ["dim", "fact"])
@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_changed_keys_first_gives_the_same_tables(spark, db, table_type, threshold):
    """Whichever joins the planner chooses."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        _compare_narrow_and_wide(spark, db, table_type)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _compare_narrow_and_wide(spark, db, table_type):
    rows = spark.range(2000).select(F.col("id").cast("int"), F.lit("a").alias("v"))
    days = [rows, rows.where("id > 9").withColumn("v", F.expr("if(id < 40, 'b', v)")), rows]
    shown = {}
    for narrow in (True, False):
        cfg = TableConfig(
            f"{db}.n{narrow}", "id", table_type=table_type, narrow_first=narrow, nk_scope="n"
        )
        for i, day in enumerate(days):
            result = build_delta(spark, replace(cfg, job_id=f"d{i}"), day)
        shown[narrow] = (result.counts, result.mirror, spark.table(cfg.delta_name))
    assert shown[True][0] == shown[False][0] == {"I": 10, "U": 30, "D": 0, "S": 1960}
    for one, two in zip(shown[True][1:], shown[False][1:], strict=True):
        assert one.count() == two.count() and one.exceptAll(two).count() == 0
    assert not [t.name for t in spark.catalog.listTables(db) if t.name.endswith("__keys")]


def test_few_changes_move_no_wide_row(spark, db):
    wide = "a" * 50
    rows = spark.range(500).select("id", F.lit(wide).alias("wide"))
    cfg = TableConfig(f"{db}.w", "id", job_id="d1")
    mirror = build_delta(spark, cfg, rows).mirror
    second = replace(cfg, job_id="d2")
    hashed = add_hashes(rows.where("id <> 3"), second)
    keys = changed_keys(hashed, mirror, second)
    assert not any(
        "wide" in part for part in plan(keys).split("\n\n") if ") Exchange" in part
    )
    name = f"{db}.w_keys"
    keys.write.saveAsTable(name)
    text = plan(classify_changed(hashed, mirror, spark.table(name), second), "simple")
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 2
    # the gathered rows are the changed ones, after their join
    assert text.count("REBALANCE") == 1 and "hashpartitioning" not in text


def test_fact_mirror_with_many_jobs_is_gathered_by_job(spark, db):
    cfg = TableConfig(f"{db}.f", "id", table_type="fact")
    rows = ""
    for i in range(1, 6):
        rows += f" {i}a"
        result = build_delta(spark, replace(cfg, job_id=f"d{i}"), frame(spark, rows))
        assert result.counts["I"] == 1
    assert {r.id: r.DWSJOB for r in result.mirror.collect()} == {i: f"d{i}" for i in range(1, 6)}


def test_a_job_with_a_third_of_all_rows_is_split_over_tasks(spark, db):
    rows = spark.range(0, 200000, 1, 8).select(
        "id",
        F.md5(F.col("id").cast("string")).alias("v"),
        F.expr("if(id % 3 = 0, 'hot', concat('j', id % 40))").alias("DWSJOB"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        version = write_mirror(rows, f"{db}.m", "j", rebalance=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = spark.table(version)
    files = written.select("DWSJOB", F.input_file_name().alias("f")).distinct()
    per_job = {r.DWSJOB: r["count"] for r in files.groupBy("DWSJOB").count().collect()}
    assert written.count() == 200000
    assert per_job["hot"] > 1
    # far fewer than one file per job and task
    assert sum(per_job.values()) < 41 * 8


def test_wide_rows_are_written_once(spark, cfg):
    """Deleted rows lie in a directory of their own that the mirror never reads."""
    build_delta(spark, cfg, frame(spark, "1a 2b 3c"))
    result = build_delta(spark, replace(cfg, job_id="d2"), frame(spark, "1a 2x"))
    version = version_name(cfg.table, "d2")
    parts = sorted(r[0] for r in list_partitions(spark, version).collect())
    assert parts == [f"DWSJOB=d2/DWSACT={a}" for a in "DSU"]
    text = plan(result.mirror)
    assert "DWSACT=D" not in text
    assert "PartitionFilters: [isnotnull(DWSACT" in text


def test_modes(spark, db, folder):
    write_dataset(frame(spark, "1a 2b"), f"{folder}/day")
    cfg = TableConfig(f"{db}.m", "id", source_path=f"{folder}/day", job_id="d1", mode="ddl")
    text = run(spark, cfg)
    assert "PARTITIONED BY (`DWSJOB`)" in text and "`DWSACT`" not in text
    assert spark.table(cfg.table).count() == 0
    result = run(spark, replace(cfg, mode="delta"))
    assert result.counts["I"] == 2
    spark.sql(
        f"CREATE TABLE {db}.p (id int, v string, PARTITION string) USING parquet "
        f"PARTITIONED BY (PARTITION) LOCATION '{folder}/none'"
    )
    add = TableConfig(
        f"{db}.p",
        "id",
        mode="add-partition",
        source_path=f"{folder}/day",
        partition_columns="PARTITION",
        partition_values="job-7",
    )
    for _ in range(2):
        run(spark, add)
    assert sorted((r.id, r.PARTITION) for r in spark.table(f"{db}.p").collect()) == [
        (1, "job-7"), (2, "job-7"),
    ]


def test_wrapped_snapshot(spark, cfg):
    wrapped = frame(spark, "1a 2b").select(
        *[F.struct(F.col(c).alias("value")).alias(c) for c in ("id", "v")]
    )
    build_delta(spark, cfg, wrapped)
    result = build_delta(spark, replace(cfg, job_id="d2"), frame(spark, "1a 2b"))
    assert result.counts == {"I": 0, "U": 0, "D": 0, "S": 2}
