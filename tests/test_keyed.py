"""Runs that drop repeated keys: rows are shuffled by their key columns, without hashes."""

from __future__ import annotations

import re
from dataclasses import replace

import pytest
from conftest import plan

from changecapture import TableConfig, build_delta, dedupe
from changecapture import columns as C
from changecapture.functions.hashing import add_hashes
from changecapture.operators import keyed
from changecapture.operators.classify import classify, mirror_of

SCHEMA = "a int, v double, b string, note string, at date"
ROWS = [
    (1, 0.0, "x", "p", None),
    (1, -0.0, "x", "q", None),
    (1, 2.0, None, "p", None),
    (None, 1.0, None, "r", None),
    (None, 5.0, None, "s", None),
    (0, 1.0, "", "t", None),
    (0, 1.0, None, "u", None),
    (None, 1.0, "", "v", None),
    (7, 3.0, "y", "w", None),
]
NEXT = [
    (1, 0.0, "x", "z", None),
    (1, 2.5, None, "p", None),
    (None, 1.0, None, "r", None),
    (None, 1.0, None, "a", None),
    (0, 1.0, "", "t", None),
    (None, 1.0, "", "changed", None),
    (8, 3.0, "y", "w", None),
    (8, 3.0, "y", "w", None),
]


@pytest.fixture
def cfg(db):
    return TableConfig(
        f"{db}.kept", "b,a", on_duplicates="keep_first", dedupe_order="at", exclusions="note", job_id="d1"
    )


def shown(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("table_type", ["dim", "fact"])
@pytest.mark.parametrize("kind", ["md5", "sha", "xxhash"])
def test_rows_are_those_of_a_run_by_hashes(spark, cfg, table_type, kind):
    cfg = replace(cfg, table_type=table_type, hash_kind=kind)
    mirror = None
    for job, rows in (("d1", ROWS), ("d2", NEXT), ("d3", ROWS[2:]), ("d4", ROWS[2:])):
        now = replace(cfg, job_id=job)
        day = spark.createDataFrame(rows, SCHEMA)
        keys = [C.KEY_HASH, *(["a", "b"] if kind == "xxhash" else [])]
        hashed = dedupe(add_hashes(day, now), keys, "at")
        expected = classify(hashed, mirror, now).localCheckpoint()
        build_delta(spark, now, day)
        mirror = mirror_of(expected)
        assert shown(spark.table(cfg.table)) == shown(mirror)
        changes = spark.table(cfg.delta_name).where(f"{C.JOB} = '{job}'")
        if job != "d1":
            expected = expected.where(f"{C.ACT} <> 'S'")
        assert shown(changes) == shown(expected)


def test_another_hash_replaces_all_rows(spark, cfg):
    day = spark.createDataFrame(ROWS, SCHEMA)
    rows = build_delta(spark, cfg, day).counts["I"]
    counts = build_delta(spark, replace(cfg, hash_kind="sha", job_id="d2"), day).counts
    assert counts == {"I": rows, "U": 0, "D": rows, "S": 0}


def test_hashes_are_computed_after_the_shuffle(spark, cfg, monkeypatch):
    from changecapture.tables import store

    plans, write = [], store.write_mirror
    monkeypatch.setattr(
        store, "write_mirror", lambda df, *a, **k: plans.append(plan(df)) or write(df, *a, **k)
    )
    day = spark.createDataFrame(ROWS, SCHEMA)
    build_delta(spark, cfg, day)
    build_delta(spark, replace(cfg, job_id="d2"), day)
    moved = [re.findall(r"\) Exchange\nInput \[\d+\]: (.*)\nArguments: (.*)", p) for p in plans]
    assert [len(m) for m in moved] == [1, 2]
    for columns, by in (moved[0][0], moved[1][0]):
        assert "DWS" not in columns and "hashpartitioning(" in by
    assert all("Partial" in p for p in plans)


def test_keys_that_spark_groups_otherwise_go_by_their_hash(cfg, spark):
    assert keyed.applies(cfg, spark.createDataFrame([], SCHEMA).schema)
    for schema in ("a double, b int, at int", "a struct<x:int>, b int, at int", "a int, b string collate UTF8_LCASE, at int"):
        assert not keyed.applies(cfg, spark.createDataFrame([], schema).schema)
