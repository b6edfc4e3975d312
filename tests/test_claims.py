from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark import inheritable_thread_target

from changecapture import ClaimLost, TableBusy, TableConfig, build_delta, replay_at_once
from changecapture.tables import claims, parts


def days(spark, rows):
    return spark.createDataFrame(rows, "id int, v string")


def run(spark, table, job, rows, **settings):
    return build_delta(spark, TableConfig(table, "id", job_id=job, **settings), days(spark, rows))


def make_old(spark, mirror, name, seconds):
    folder = claims._Folder(spark, mirror)
    then = spark._jvm.System.currentTimeMillis() - int(seconds * 1000)
    folder.files.setTimes(folder.at(name), then, -1)


def test_one_of_many_that_claim_at_once_wins(spark, db):
    ready, leave = threading.Barrier(8), threading.Event()
    told = []

    def take(_):
        ready.wait()
        try:
            with claims.claimed(spark, f"{db}.t"):
                told.append("won")
                leave.wait(60)
        except TableBusy:
            told.append("busy")
        if told.count("busy") == 7:
            leave.set()

    with ThreadPoolExecutor(8) as pool:
        target = inheritable_thread_target(spark)(take)
        for done in [pool.submit(target, i) for i in range(8)]:
            done.result()
    assert sorted(told) == ["busy"] * 7 + ["won"]


def test_a_run_waits_for_nobody_and_changes_nothing_while_another_is_at_work(spark, db):
    table = f"{db}.t"
    run(spark, table, "d1", [(1, "a"), (2, "b")])
    before = spark.table(table).collect()
    with claims.claimed(spark, table):
        for job in ("d1", "d2"):
            with pytest.raises(TableBusy):
                run(spark, table, job, [(1, "x")])
        with pytest.raises(TableBusy):
            replay_at_once(spark, TableConfig(table, "id", job_id="d3"), [("d3", days(spark, [(1, "x")]))])
    assert spark.table(table).collect() == before
    assert run(spark, table, "d2", [(1, "x")]).counts == {"I": 0, "U": 1, "D": 1, "S": 0}


@pytest.mark.parametrize("settings", [{}, {"table_type": "fact", "copy_on_write": True}])
def test_of_two_runs_at_once_one_wins_and_nothing_is_lost(spark, db, settings):
    table = f"{db}.t"
    run(spark, table, "d1", [(i, "a") for i in range(100)], **settings)
    ready = threading.Barrier(2)
    told = {}

    def go(job, value):
        ready.wait()
        try:
            told[job] = run(spark, table, job, [(i, value) for i in range(100)], **settings).counts
        except TableBusy:
            told[job] = None

    with ThreadPoolExecutor(2) as pool:
        target = inheritable_thread_target(spark)(go)
        for done in [pool.submit(target, j, v) for j, v in (("d2", "b"), ("d3", "c"))]:
            done.result()
    lost = [j for j, counts in told.items() if counts is None]
    assert len(lost) == 1
    won = ({"d2", "d3"} - set(lost)).pop()
    assert told[won]["U"] == 100
    value = {"d2": "b", "d3": "c"}
    assert {r.v for r in spark.table(table).collect()} == {value[won]}
    assert run(spark, table, lost[0], [(i, value[lost[0]]) for i in range(100)], **settings).counts["U"] == 100
    assert spark.table(f"{table}_delta").count() == 300


def test_a_claim_that_is_not_renewed_is_revoked_and_cannot_commit(spark, db):
    mirror = f"{db}.t"
    with claims.claimed(spark, mirror) as gone:
        make_old(spark, mirror, gone.name, 2 * claims.LEASE)
        with claims.claimed(spark, mirror) as claim:
            with pytest.raises(ClaimLost):
                gone.commit()
            claim.commit()
            claim.commit()
            with pytest.raises(TableBusy), claims.claimed(spark, mirror):
                pass


def test_a_claim_is_renewed_while_its_run_lasts(spark, db):
    mirror = f"{db}.t"
    with claims.claimed(spark, mirror, lease=1.5):
        threading.Event().wait(4)
        with pytest.raises(TableBusy), claims.claimed(spark, mirror, lease=1.5):
            pass


def test_files_of_old_claims_go(spark, db):
    table = f"{db}.t"
    for number in range(4):
        with claims.claimed(spark, table) as claim:
            claim.commit()
    names = claims._Folder(spark, table).names()
    assert {n.split(".")[0] for n in names} == {"3".zfill(12)}
    assert parts.files_root(spark, table).endswith("t__files")


def test_a_number_taken_too_late_is_given_back(spark, db, monkeypatch):
    mirror = f"{db}.t"
    for _ in range(3):
        with claims.claimed(spark, mirror):
            pass
    monkeypatch.setattr(claims, "_next", lambda *_: "1".zfill(12))
    with pytest.raises(TableBusy), claims.claimed(spark, mirror):
        pass
    assert "1".zfill(12) not in claims._Folder(spark, mirror).names()


def test_a_failed_run_lets_the_next_one_in(spark, db):
    table = f"{db}.t"
    with pytest.raises(Exception, match="more than once"):
        run(spark, table, "d1", [(1, "a"), (1, "b")])
    assert run(spark, table, "d2", [(1, "a")]).counts["I"] == 1
