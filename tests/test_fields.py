from __future__ import annotations

import pytest
from pyspark.sql import types as T

from changecapture import ConfigError, FieldSets, TableConfig, add_hashes, narrow, project

SCHEMA = "ID int, T1 string, created string, NK string, DwsJob string, yy int, T2 string"


@pytest.fixture
def df(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def cfg():
    return TableConfig(
        "t",
        "t1,id",
        exclusions="CREATED,updated",
        partition_columns="yy",
        partition_values="1",
        inline=False,
    )


def test_sets(df, cfg):
    sets = FieldSets(cfg, df.schema)
    names = lambda fields: [f.name for f in fields]
    assert names(sets.ids) == ["ID", "T1"]
    assert names(sets.s_part_keys) == ["yy"]
    assert names(sets.hash_ex) == ["created", "NK", "DwsJob", "yy"]
    assert names(sets.payload) == df.columns
    assert names(sets.payload_bare) == ["created", "NK", "DwsJob", "yy", "T2"]
    assert names(sets.payload_hashex) == ["ID", "T1", "T2"]
    assert names(sets.payload_metaex) == ["ID", "T1", "created", "yy", "T2"]
    assert names(sets.valued) == ["T2"]
    assert names(sets.meta) == ["NK", "DWSJOB", "DWSUNIACT", "DWSARCHIVE", "DWSACT"]
    assert names(sets.meta_table) == [
        *names(sets.meta), "DWSKEYHASH", "DWSVALHASH", "ID", "T1", "yy",
    ]


def test_fact_lineage(df):
    sets = FieldSets(TableConfig("t", "id", table_type="fact"), df.schema)
    assert [f.name for f in sets.meta] == ["DWSJOB", "DWSAUTO", "DWSARCHIVE", "DWSACT"]
    assert [f.nullable for f in sets.meta] == [False, True, True, True]


def test_project(df, cfg):
    assert project(df, cfg, "ids").columns == ["ID", "T1"]
    assert narrow(df, cfg).columns == df.columns
    with pytest.raises(ConfigError):
        project(df, cfg, "nothing")


def test_source_columns_named_like_lineage_are_refused(df):
    with pytest.raises(ConfigError, match="NK, DwsJob"):
        add_hashes(df, TableConfig("t", "id"))
    linked = add_hashes(df, TableConfig("t", "id", inline=False))
    assert linked.columns == ["DWSKEYHASH", "DWSVALHASH", "ID"]


def test_missing_key_and_ambiguous_names_are_refused(spark, df):
    with pytest.raises(ConfigError, match="no key column zz"):
        FieldSets(TableConfig("t", "id,zz"), df.schema)
    two = spark.createDataFrame([], "id int").schema.add("ID", T.IntegerType())
    with pytest.raises(ConfigError, match="case"):
        FieldSets(TableConfig("t", "id"), two)
