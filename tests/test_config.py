from __future__ import annotations

import pytest

from changecapture import ConfigError, TableConfig
from changecapture.config import name_list, version_name


def test_names_are_trimmed_lowered_and_empty_ones_dropped():
    assert name_list(" ID, T1 ,,id") == ("id", "t1")
    assert name_list("") == ()
    assert name_list(["A", " b "]) == ("a", "b")


def test_kinds_ignore_case():
    cfg = TableConfig("t", "ID", table_type="FACT", hash_kind="MD5", mode="DELTA")
    assert (cfg.table_type, cfg.hash_kind, cfg.mode) == ("fact", "md5", "delta")


@pytest.mark.parametrize(
    "settings",
    [
        {"keys": ""},
        {"keys": "id", "exclusions": "ID"},
        {"keys": "id", "hash_kind": "crc"},
        {"keys": "id", "table_type": "view"},
        {"keys": "id", "on_duplicates": "ignore"},
        {"keys": "id", "partition_columns": "yy,mn", "partition_values": {"yy": 1}},
        {"keys": "id", "partition_columns": "yy,mn", "partition_values": "1"},
        {"keys": "id", "buckets": 0},
        {"keys": "id", "buckets": 8, "table_type": "fact"},
        {"keys": "id", "job_id": ""},
        {"keys": "id", "inline": False, "on_duplicates": "keep_first"},
        {"keys": "id", "inline": False, "narrow_first": True},
        {"keys": "id", "hash_kind": "murmur", "narrow_first": True},
        {"keys": "id", "buckets": 8, "narrow_first": True},
    ],
)
def test_settings_that_cannot_work_are_refused(settings):
    with pytest.raises(ConfigError):
        TableConfig("t", **settings)


def test_partition_value_is_the_job_unless_given():
    assert TableConfig("t", "id", job_id="j").partition_value("export_date") == "j"
    assert TableConfig("t", "id", partition_values="2020").partition_value("EXPORT_DATE") == "2020"
    many = TableConfig("t", "id", partition_columns="yy,mn", partition_values={"YY": 1, "mn": 0})
    assert (many.partition_value("yy"), many.partition_value("mn")) == (1, 0)
    with pytest.raises(ConfigError):
        TableConfig("t", "id", partition_columns="yy,mn").partition_value("yy")


def test_a_job_id_is_drawn_for_every_run():
    assert TableConfig("t", "id").job_id != TableConfig("t", "id").job_id


def test_version_names_tell_job_ids_apart():
    assert version_name("db.t", "day1") == "db.t__day1"
    names = {version_name("t", j) for j in ("a-b", "a_b", "a.b", "A_B", "a_b_")}
    assert len(names) == 5
