"""The shape of the physical plans."""

from __future__ import annotations

from dataclasses import replace

import pytest
from conftest import plan

from changecapture import (
    add_hashes,
    classify,
    delta_of,
    dedupe,
    duplicate_keys,
    key_hash,
    mirror_of,
    value_hash,
)
from workload.snapshots import SOURCES, today, tomorrow


@pytest.fixture
def sides(spark, data):
    source = SOURCES["orders"]
    cfg = source.config("j0")
    mirror = mirror_of(classify(add_hashes(today(spark, data, "orders"), cfg), None, cfg))
    return add_hashes(tomorrow(spark, data, "orders"), cfg), mirror, replace(cfg, job_id="j1")


def test_one_join_two_shuffles_no_python(sides):
    text = plan(classify(*sides), "simple")
    assert text.count("SortMergeJoin") == 1 and "FullOuter" in text
    assert text.count("Exchange hashpartitioning") == 2
    for node in ("Python", "Arrow", "MapInPandas", "Cartesian", "NestedLoop", "RDD"):
        assert node not in text


def test_labels_alone_read_and_move_no_payload(sides):
    """Columns only the payload needs are pruned from both sides of the join."""
    new, mirror, cfg = sides
    text = plan(classify(new, mirror, cfg).select("DWSACT", "DWSKEYHASH"))
    exchanges = [part for part in text.split("\n\n") if ") Exchange" in part]
    assert len(exchanges) == 2
    assert not any("totalprice" in part for part in exchanges)
    assert "o_totalprice" not in text.split("ReadSchema: ")[1].split("\n")[0]


def test_hashes_read_only_what_they_cover(spark, data):
    df = today(spark, data, "orders")
    text = plan(df.select(key_hash(df, "o_orderkey")))
    assert "ReadSchema: struct<o_orderkey:bigint>" in text
    text = plan(df.select(value_hash(df, "o_orderkey", "o_totalprice,o_custkey")))
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "o_totalprice" not in schema and "o_custkey" not in schema and "o_orderkey" not in schema


def test_hashing_does_not_shuffle(spark, data):
    cfg = SOURCES["orders"].config("j0")
    df = classify(add_hashes(today(spark, data, "orders"), cfg), None, cfg)
    assert "Exchange" not in plan(delta_of(df))


def test_copies_are_counted_before_the_shuffle(spark, data):
    text = plan(duplicate_keys(today(spark, data, "lineitem"), "l_orderkey,l_linenumber"), "simple")
    assert "partial_count" in text and text.count("Exchange") == 1
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text


def test_dropping_copies_limits_every_key_before_the_shuffle(spark, data):
    text = plan(dedupe(today(spark, data, "lineitem"), "l_orderkey,l_linenumber"), "simple")
    assert "row_number(), 1, Partial" in text and text.count("Exchange") == 1


def test_the_join_reuses_the_shuffle_of_dropping_copies(spark, data, sides):
    new, mirror, cfg = sides
    unique = dedupe(new, "DWSKEYHASH", "o_orderdate")
    text = plan(classify(unique, mirror, cfg), "simple")
    assert text.count("Exchange hashpartitioning") == 2
