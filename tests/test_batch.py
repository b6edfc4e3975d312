from __future__ import annotations

import pytest

from changecapture import BatchFailed, DeltaStep, PartitionStep, TableConfig, run_batch


def step(db, folder, name, rows, day="d1", **settings):
    return DeltaStep(
        TableConfig(f"{db}.{name}", "id", job_id=day, **settings),
        lambda spark: spark.createDataFrame(rows, "id int, v string"),
        f"{folder}/{name}",
        day,
    )


def test_tables_are_landed_captured_and_registered(spark, db, folder):
    for day, rows in (("d1", [(1, "a"), (2, "b")]), ("d2", [(1, "a"), (2, "c"), (3, "d")])):
        steps = [step(db, folder, n, rows, day) for n in ("x", "y", "z")]
        steps.append(
            PartitionStep(f"{db}.w", lambda s: s.range(5), f"{folder}/w", day)  # noqa: B023
        )
        done = run_batch(spark, steps, parallel=3)
    assert set(done) == {f"{db}.{n}" for n in "xyzw"}
    assert all(done[f"{db}.{n}"].counts == {"I": 1, "U": 1, "D": 0, "S": 1} for n in "xyz")
    assert "export_date" not in done[f"{db}.x"].mirror.columns
    assert done[f"{db}.w"].groupBy("export_date").count().collect() != []
    assert spark.table(f"{db}.w").count() == 10


def test_a_failing_table_does_not_stop_the_others(spark, db, folder):
    steps = [
        step(db, folder, "good", [(1, "a")]),
        step(db, folder, "bad", [(1, "a"), (1, "b")]),
        step(db, folder, "fine", [(1, "a")]),
    ]
    with pytest.raises(BatchFailed, match="1 of 3 tables failed.*bad: DuplicateKeys") as caught:
        run_batch(spark, steps)
    assert set(caught.value.done) == {f"{db}.good", f"{db}.fine"}
    assert spark.table(f"{db}.fine").count() == 1


def test_tables_have_pools_and_the_largest_begin_first(spark, db, folder):
    sizes = {"small": 10, "large": 30_000, "middle": 3_000}
    seen = []

    def extract(name):
        def rows(spark):
            pool = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
            seen.append((name, pool))
            return spark.range(sizes[name]).selectExpr("cast(id as int) id", "md5(string(id)) v")

        return rows

    for day in ("d1", "d2"):
        seen.clear()
        steps = [
            DeltaStep(TableConfig(f"{db}.{n}", "id", job_id=day), extract(n), f"{folder}/{n}", day)
            for n in sizes
        ]
        steps.append(step(db, folder, f"bad_{day}", [(1, "a"), (1, "b")], day))
        with pytest.raises(BatchFailed, match="1 of 4 tables failed") as caught:
            run_batch(spark, steps, parallel=1)
        assert set(caught.value.done) == {f"{db}.{n}" for n in sizes}
        assert sorted(seen) == sorted((n, f"{db}.{n}") for n in sizes)
    assert [n for n, _ in seen] == ["large", "middle", "small"]
    assert spark.conf.get("spark.scheduler.mode") == "FAIR"


def test_a_batch_names_every_table_once(spark, db, folder):
    with pytest.raises(ValueError, match="more than one step"):
        run_batch(spark, [step(db, folder, "x", []), step(db, folder, "X", [])])
