"""Many days at once against one day after the other, and days that land in buckets."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest
from conftest import plan
from pyspark.errors import AnalysisException

from changecapture import (
    ConfigError,
    DuplicateKeys,
    JobAlreadyFinished,
    TableConfig,
    build_delta,
    classify,
    land_hashed,
    replay,
    replay_at_once,
)
from changecapture.operators.classify import ranked
from changecapture.plans.history import history
from changecapture.tables import store

SCHEMA = "id int, kind string, v string, note string"


def snapshots(spark, seed, days, first=0):
    """Keys come, go and return; values and an excluded column change."""
    rng = random.Random(seed)
    out = []
    for n in range(days):
        rows = [
            (i, None if i == 3 else "k", rng.choice(["a", "b", None]), f"{n}")
            for i in range(25)
            if rng.random() < 0.7
        ]
        out.append((f"j{first + n}", spark.createDataFrame(rows, SCHEMA)))
    return out


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize(
    "more", [{}, {"table_type": "fact"}, {"hash_kind": "murmur"}]
)
def test_equals_replay(spark, db, more):
    settings = {"exclusions": "note", "job_id": "x", "nk_scope": "same"} | more
    one, two = (TableConfig(f"{db}.{n}", "id,kind", **settings) for n in ("a", "b"))
    days = snapshots(spark, 1, 5)
    replay(spark, one, days)
    done = replay_at_once(spark, two, days)
    assert rows_of(spark.table(two.delta_name)) == rows_of(spark.table(one.delta_name))
    assert rows_of(spark.table(two.mirror_name)) == rows_of(spark.table(one.mirror_name))
    assert [d.job_id for d in done] == [j for j, _ in days]
    # on top of a mirror, and then a day alone
    more_days = snapshots(spark, 2, 3, first=5)
    replay(spark, one, more_days)
    replay_at_once(spark, two, more_days[:2])
    build_delta(spark, replace(two, job_id="j7"), more_days[2][1])
    assert rows_of(spark.table(two.delta_name)) == rows_of(spark.table(one.delta_name))
    assert rows_of(spark.table(two.mirror_name)) == rows_of(spark.table(one.mirror_name))


def test_one_shuffle_for_all_days(spark):
    cfg = TableConfig("t", "id", exclusions="note", job_id="j0")
    from changecapture.plans.build import hash_source

    days = [(j, hash_source(d, cfg)) for j, d in snapshots(spark, 1, 6)]
    mirror = classify(days[0][1], None, replace(cfg, job_id="old"))
    text = plan(history(mirror, days, cfg), "simple")
    assert text.count("Exchange") == 1 and "Join" not in text and text.count("Sort ") == 1


def test_a_broken_off_replay_is_repaired_or_undone(spark, db, monkeypatch):
    cfg = TableConfig(f"{db}.t", "id,kind", exclusions="note", job_id="x")
    days = snapshots(spark, 3, 4)
    replay_at_once(spark, cfg, days[:1])

    def fail(*args):
        raise RuntimeError("lost")

    for _ in range(2):
        with monkeypatch.context() as patch:
            patch.setattr(store, "swap_mirror", fail)
            with pytest.raises(RuntimeError):
                replay_at_once(spark, cfg, days[1:3])
    # another job follows instead: nothing of the replay is left
    build_delta(spark, replace(cfg, job_id="other"), days[3][1])
    jobs = {r[0] for r in spark.table(cfg.delta_name).select("DWSJOB").distinct().collect()}
    assert jobs == {"j0", "other"}
    before = rows_of(spark.table(cfg.delta_name))
    with monkeypatch.context() as patch:
        patch.setattr(store, "swap_mirror", fail)
        with pytest.raises(RuntimeError):
            replay_at_once(spark, cfg, days[1:3])
    done = replay_at_once(spark, cfg, days[1:3])
    assert done[1].mirror.count() == days[2][1].count()
    assert set(before) < set(rows_of(spark.table(cfg.delta_name)))
    assert rows_of(replay_at_once(spark, cfg, days[1:3])[0].delta) == rows_of(done[0].delta)
    with pytest.raises(JobAlreadyFinished):
        replay_at_once(spark, cfg, [("j0", days[0][1]), ("new", days[0][1])])


def test_repeated_keys_and_settings(spark, db):
    cfg = TableConfig(f"{db}.t", "id", job_id="x")
    day = spark.createDataFrame([(1, "k", "a", "n"), (1, "k", "b", "n")], SCHEMA)
    with pytest.raises(DuplicateKeys):
        replay_at_once(spark, cfg, [("j0", day.limit(1)), ("j1", day)])
    assert replay_at_once(spark, cfg, []) == []
    with pytest.raises(ConfigError):
        replay_at_once(spark, replace(cfg, buckets=4), [("j0", day)])
    with pytest.raises(ConfigError):
        replay_at_once(spark, cfg, [("j0", day.limit(1)), ("j0", day.limit(1))])


def test_a_day_in_buckets_joins_without_exchange(spark, db):
    cfg = TableConfig(f"{db}.t", "id,kind", exclusions="note", buckets=4, job_id="j0")
    plain = replace(cfg, table=f"{db}.p", nk_scope=cfg.nk_scope, buckets=None)
    for job, day in snapshots(spark, 4, 3):
        own = replace(cfg, job_id=job)
        table = land_hashed(spark, own, day)
        if job != "j0":
            sides = (ranked(spark.table(table), ["DWSKEYHASH"]), ranked(spark.table(cfg.mirror_name), ["DWSKEYHASH"], repeats=False))
            text = plan(classify(*sides, own), "simple")
            assert "FullOuter" in text and "Exchange" not in text
        done = build_delta(spark, own, hashed=spark.table(table))
        want = build_delta(spark, replace(plain, job_id=job), day)
        assert rows_of(done.delta) == rows_of(want.delta) and done.counts == want.counts
        assert rows_of(done.mirror) == rows_of(want.mirror)
    with pytest.raises(ConfigError):
        land_hashed(spark, plain, day)


def test_landed_hashes_are_only_taken_as_such(spark, db):
    """A snapshot with columns named like the hashes is still refused."""
    cfg = TableConfig(f"{db}.t", "id", buckets=2, job_id="j0")
    day = spark.createDataFrame([(1, "k", "a", "n")], SCHEMA)
    table = land_hashed(spark, cfg, day)
    with pytest.raises((ConfigError, AnalysisException)):
        build_delta(spark, cfg, spark.table(table))
