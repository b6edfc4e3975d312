"""Registered queries against their SQL, on whole tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from changecapture.llm.oracle import ORACLE
from changecapture.llm.queries import QUERIES


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for path in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def test_names():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    order = [columns.index(c) for c in sorted(columns)]
    want = sorted(repr([row[i] for i in order]) for row in cursor.fetchall())
    assert sorted(repr([row[c] for c in sorted(columns)]) for row in df.collect()) == want
