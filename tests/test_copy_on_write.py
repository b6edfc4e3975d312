"""Fact mirrors whose versions share files, and digests of buckets."""

from __future__ import annotations

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from changecapture import ConfigError, DuplicateKeys, TableConfig, build_delta
from changecapture.operators import digests as D
from changecapture.operators.classify import changed_keys
from changecapture.plans import build
from changecapture.tables import catalog, parts, store
from changecapture.tables.catalog import versions

SCHEMA = "id int, v string, note string"


def day(spark, rows):
    return spark.createDataFrame([(i, v, f"seen {v}") for i, v in rows.items()], SCHEMA)


#: Snapshots of six days; every day touches few of the jobs before.
DAYS = [
    {i: "a" for i in range(40)},
    {i: "a" for i in range(40)} | {100: "b", 101: "b"},
    {i: "a" for i in range(40)} | {100: "b", 101: "c", 200: "c"},
    {i: "a" for i in range(40)} | {100: "b", 101: "c", 200: "c", 300: "d"},
    {i: "a" for i in range(39)} | {100: "b", 101: "c", 200: "c", 300: "d"},
    {i: "a" for i in range(39)} | {100: "b", 101: "c", 200: "c", 300: "d"},
]


def config(db, name="t", **more):
    settings = {"table_type": "fact", "exclusions": "note", "copy_on_write": True, "job_id": "j0"} | more
    return TableConfig(f"{db}.{name}", "id", **settings)


def rows_of(df):
    columns = sorted(df.columns)
    return sorted(map(str, df.select(columns).collect()))


def files(spark, cfg):
    root = parts.files_root(spark, cfg.mirror_name).removeprefix("file:")
    return {str(p) for p in Path(root).glob("rows/**/*.orc")}


@pytest.mark.parametrize("more", [{}, {"hash_kind": "sha", "digest_buckets": 16}])
def test_same_rows_as_without(spark, db, more):
    cfg, plain = config(db, **more), config(db, "p", copy_on_write=False, hash_kind=more.get("hash_kind", "md5"))
    for n, rows in enumerate(DAYS[:5]):
        job = f"j{n}"
        one = build_delta(spark, replace(cfg, job_id=job), day(spark, rows))
        two = build_delta(spark, replace(plain, job_id=job), day(spark, rows))
        assert one.counts == two.counts
        assert rows_of(one.delta) == rows_of(two.delta)
        assert rows_of(one.mirror) == rows_of(two.mirror)


def test_files_written_follow_the_change(spark, db):
    cfg = config(db)
    known, written = set(), []
    for n, rows in enumerate(DAYS):
        build_delta(spark, replace(cfg, job_id=f"j{n}"), day(spark, rows))
        now = files(spark, cfg)
        fresh = {p.split("/rows/")[1].split("/", 1)[1].rsplit("/", 1)[0] for p in now - known}
        known |= now
        written.append(sorted(fresh))
    assert written == [
        ["DWSJOB=j0/DWSACT=I"],
        ["DWSJOB=j1/DWSACT=I"],
        # 101 of j1 changes: the rest of that job is written again
        ["DWSJOB=j1/DWSACT=S", "DWSJOB=j2/DWSACT=I", "DWSJOB=j2/DWSACT=U"],
        # two places of one job become one
        ["DWSJOB=j2/DWSACT=S", "DWSJOB=j3/DWSACT=I"],
        ["DWSJOB=j0/DWSACT=S", "DWSJOB=j4/DWSACT=D"],
        [],
    ]


def test_directories_go_once_nobody_names_them(spark, db):
    cfg = config(db)
    for n, rows in enumerate(DAYS):
        if n:
            before = spark.table(cfg.mirror_name)
            want = rows_of(before)
            before = spark.table(cfg.mirror_name)
        build_delta(spark, replace(cfg, job_id=f"j{n}"), day(spark, rows))
        if n:
            # a query planned on the version before still finds its files
            assert rows_of(before) == want
        now = versions(spark, cfg.mirror_name)
        named = {
            p.path.removeprefix("file:")
            for v in (now.current, now.previous)
            for p in parts.manifest(spark, cfg.mirror_name, v) or ()
        }
        held = {p.rsplit("/", 1)[0] for p in files(spark, cfg)}
        assert held == named and now.outdated is None
    # five versions ago, and still where it was written
    assert any("t__j0/DWSJOB=j0" in p for p in held) is False
    assert any("t__j2/DWSJOB=j1" in p for p in held)


@pytest.mark.parametrize("broken", ["append_delta", "swap_mirror"])
def test_a_broken_off_run_is_undone_or_repaired(spark, db, monkeypatch, broken):
    cfg = config(db, digest_buckets=8)
    for n in (0, 1):
        build_delta(spark, replace(cfg, job_id=f"j{n}"), day(spark, DAYS[n]))
    want = rows_of(spark.table(cfg.mirror_name))
    held = files(spark, cfg)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(store, broken, fail)
        with pytest.raises(RuntimeError):
            build_delta(spark, replace(cfg, job_id="j2"), day(spark, DAYS[2]))
    assert rows_of(spark.table(cfg.mirror_name)) == want and held < files(spark, cfg)
    if broken == "append_delta":
        # another job follows: what the broken one wrote goes, what it shared stays
        done = build_delta(spark, replace(cfg, job_id="jx"), day(spark, DAYS[1]))
        assert done.counts == {"I": 0, "U": 0, "D": 0, "S": 42}
        assert files(spark, cfg) == held and not spark.catalog.tableExists(f"{cfg.mirror_name}__j2")
    else:
        done = build_delta(spark, replace(cfg, job_id="j2"), day(spark, DAYS[2]))
        assert done.counts == {"I": 1, "U": 1, "D": 0, "S": 41}
    assert done.mirror.count() == sum(done.counts.values())


def test_repeated_keys_leave_the_shared_files(spark, db):
    cfg = config(db)
    build_delta(spark, cfg, day(spark, DAYS[0]))
    held, twice = files(spark, cfg), day(spark, DAYS[1]).union(day(spark, {3: "z"}))
    with pytest.raises(DuplicateKeys):
        build_delta(spark, replace(cfg, job_id="j1"), twice)
    assert files(spark, cfg) == held and spark.table(cfg.mirror_name).count() == 40


def test_on_an_old_mirror_and_off_again(spark, db):
    cfg = config(db)
    for n, rows in enumerate(DAYS):
        on = n in (2, 3, 4)
        done = build_delta(spark, replace(cfg, job_id=f"j{n}", copy_on_write=on), day(spark, rows))
        shown = {r.id: (r.v, r.DWSJOB) for r in done.mirror.collect()}
        assert {k: v for k, (v, _) in shown.items()} == rows
        assert shown[0][1] == "j0" and (n < 2 or shown[101] == ("c", "j2"))


def test_empty_snapshot_and_return(spark, db):
    cfg = config(db, digest_buckets=4)
    build_delta(spark, cfg, day(spark, DAYS[0]))
    nothing = spark.createDataFrame([], SCHEMA)
    gone = build_delta(spark, replace(cfg, job_id="j1"), nothing)
    assert gone.counts == {"I": 0, "U": 0, "D": 40, "S": 0} and gone.mirror.count() == 0
    back = build_delta(spark, replace(cfg, job_id="j2"), day(spark, {1: "a"}))
    assert back.counts == {"I": 1, "U": 0, "D": 0, "S": 0} and back.mirror.count() == 1


@pytest.mark.parametrize("table_type,more", [("fact", {"copy_on_write": True}), ("dim", {"copy_on_write": False, "narrow_first": True})])
def test_only_differing_buckets_are_joined(spark, db, monkeypatch, table_type, more):
    cfg = config(db, table_type=table_type, digest_buckets=1024, **more)
    seen = []

    def counted(new, old, own):
        seen.append((new.count(), old.count()))
        return changed_keys(new, old, own)

    monkeypatch.setattr(build, "changed_keys", counted)
    rows = {i: "a" for i in range(500)}
    build_delta(spark, cfg, day(spark, rows))
    changed = rows | {7: "b", 900: "c"}
    del changed[8]
    done = build_delta(spark, replace(cfg, job_id="j1"), day(spark, changed))
    assert done.counts == {"I": 1, "U": 1, "D": 1, "S": 498}
    again = build_delta(spark, replace(cfg, job_id="j2"), day(spark, changed))
    assert again.counts == {"I": 0, "U": 0, "D": 0, "S": 500}
    (new, old), nothing = seen
    assert 2 <= new <= 12 and 2 <= old <= 12 and nothing == (0, 0)


def test_digests_are_carried_forward(spark, db):
    cfg = config(db, digest_buckets=8)
    for n, rows in enumerate(DAYS):
        build_delta(spark, replace(cfg, job_id=f"j{n}"), day(spark, rows))
        version = versions(spark, cfg.mirror_name).current
        stored = parts.read_digests(spark, cfg.mirror_name, version, 8)
        assert rows_of(stored) == rows_of(D.digests(spark.table(cfg.mirror_name), 8))


def test_digests_without_stored_ones_and_other_numbers(spark, db):
    cfg = config(db)
    build_delta(spark, cfg, day(spark, DAYS[1]))
    for n, buckets in enumerate((8, 16, None, 8), 2):
        rows = DAYS[1] | {1: f"x{n}"}
        done = build_delta(spark, replace(cfg, job_id=f"j{n}", digest_buckets=buckets), day(spark, rows))
        assert done.counts["U"] == 1 and done.counts["S"] == 41


def test_digests_do_not_depend_on_the_order(spark):
    rows = spark.range(200).select(
        F.md5(F.col("id").cast("string")).alias("DWSKEYHASH"), F.md5((F.col("id") % 3).cast("string")).alias("DWSVALHASH")
    )
    one, two = D.digests(rows, 16), D.digests(rows.orderBy(F.rand(1)).repartition(7), 16)
    assert rows_of(one) == rows_of(two) and D.differing(one, two).count() == 0
    # two rows that swap their values
    swapped = rows.withColumn("DWSVALHASH", F.when(F.col("DWSKEYHASH") == F.md5(F.lit("1")), F.md5(F.lit("2"))).otherwise(F.col("DWSVALHASH")))
    assert D.differing(D.digests(swapped, 16), one).count() == 1


@pytest.mark.parametrize(
    "more",
    [
        {"table_type": "dim"},
        {"inline": False},
        {"hash_kind": "murmur"},
        {"copy_on_write": False, "digest_buckets": 4},
        {"digest_buckets": 0},
        {"digest_buckets": 1 << 17},
    ],
)
def test_settings_that_do_not_go_together(more):
    with pytest.raises(ConfigError):
        config("db", **more)


def test_jobs_of_any_name(spark, db):
    """Names of jobs are escaped in paths."""
    cfg = config(db, job_id="a/b=c d:1%")
    build_delta(spark, cfg, day(spark, DAYS[0]))
    done = build_delta(spark, replace(cfg, job_id="it's [2]"), day(spark, DAYS[1]))
    assert done.counts == {"I": 2, "U": 0, "D": 0, "S": 40}
    assert {r.DWSJOB for r in done.mirror.collect()} == {"a/b=c d:1%", "it's [2]"}
    assert catalog.versions(spark, cfg.mirror_name).pending is None
