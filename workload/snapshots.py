"""Two daily snapshots of every given table, as SQL both engines understand.

Day one is the table as it is. Day two is the whole table again with these columns
rewritten: some rows get another key (they are deleted under the old key and inserted
under the new one), some get another value (updated), and excluded columns change
everywhere (no effect on any label).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changecapture import TableConfig


@dataclass(frozen=True)
class Source:
    """A given table: its columns, keys, excluded columns, and the rewrites of day two."""

    name: str
    columns: tuple[str, ...]
    keys: tuple[str, ...]
    excluded: tuple[str, ...] = ()
    edits: dict[str, str] = field(default_factory=dict)

    @property
    def valued(self) -> list[str]:
        return [c for c in self.columns if c not in self.keys and c not in self.excluded]

    def config(self, job_id: str, table: str | None = None, **settings) -> TableConfig:
        return TableConfig(
            table or self.name,
            self.keys,
            exclusions=self.excluded,
            job_id=job_id,
            nk_scope=self.name,
            **settings,
        )

    def next_day_sql(self) -> str:
        shown = [f"{self.edits[c]} AS {c}" if c in self.edits else c for c in self.columns]
        return f"SELECT {', '.join(shown)} FROM {self.name}"


def _source(name: str, columns: str, keys: str, excluded: str = "", **edits: str) -> Source:
    return Source(
        name, tuple(columns.split()), tuple(keys.split()), tuple(excluded.split()), edits
    )


def _rekey(key: str, when: str) -> str:
    return f"CASE WHEN {when} THEN -{key} - 1 ELSE {key} END"


def _mark(column: str, when: str) -> str:
    return f"CASE WHEN {when} THEN {column} || '*' ELSE {column} END"


SOURCES = {
    s.name: s
    for s in (
        _source(
            "region",
            "r_regionkey r_name",
            "r_regionkey",
            r_regionkey=_rekey("r_regionkey", "r_name = 'ASIA'"),
            r_name=_mark("r_name", "r_name = 'EUROPE'"),
        ),
        _source(
            "nation",
            "n_nationkey n_name n_regionkey",
            "n_nationkey",
            n_nationkey=_rekey("n_nationkey", "n_regionkey = 1"),
            n_name=_mark("n_name", "n_regionkey = 2"),
        ),
        _source(
            "supplier",
            "s_suppkey s_name s_nationkey s_acctbal",
            "s_suppkey",
            "s_acctbal",
            s_suppkey=_rekey("s_suppkey", "s_nationkey = 7"),
            s_name=_mark("s_name", "s_nationkey < 5"),
            s_acctbal="s_acctbal + 1",
        ),
        _source(
            "part",
            "p_partkey p_name p_brand p_type p_size p_retailprice",
            "p_partkey",
            "p_retailprice",
            p_partkey=_rekey("p_partkey", "p_type = 'ECONOMY'"),
            p_name=_mark("p_name", "p_size < 5"),
            p_retailprice="p_retailprice + 1",
        ),
        _source(
            "customer",
            "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
            "c_custkey",
            "c_acctbal",
            c_custkey=_rekey("c_custkey", "c_mktsegment = 'MACHINERY'"),
            c_mktsegment=_mark("c_mktsegment", "c_nationkey < 5"),
            c_acctbal="c_acctbal + 1",
        ),
        _source(
            "orders",
            "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
            "o_orderkey",
            "o_totalprice",
            o_orderkey=_rekey("o_orderkey", "o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'"),
            o_orderstatus=_mark("o_orderstatus", "o_orderpriority = '5-LOW'"),
            o_totalprice="o_totalprice + 1",
        ),
        _source(
            "conversations",
            "conv_id turn role text",
            "conv_id turn",
            turn=_rekey("turn", "role = 'system'"),
            text=_mark("text", "role = 'assistant'"),
        ),
        _source(
            "lineitem",
            "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount "
            "l_tax l_returnflag l_linestatus l_shipdate",
            "l_orderkey l_linenumber",
            l_linenumber=_rekey("l_linenumber", "l_returnflag = 'R' AND l_discount < 0.02"),
            l_linestatus=_mark("l_linestatus", "l_quantity < 5"),
        ),
        _source("events", "event_id ts user_id event_type value props", "event_id"),
        _source("documents", "doc_id text lang source n_chars", "doc_id"),
    )
}


def today(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Day one: the whole table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tomorrow(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Day two: the whole table with its rewrites."""
    source = SOURCES[name]
    return today(spark, sf_dir, name).select(
        *[F.expr(source.edits.get(c, c)).alias(c) for c in source.columns]
    )


# nulls for ``customer``: one key, and values of several rows
NULLED = {
    "c_custkey": "nullif(c_custkey, 7)",
    "c_name": "CASE WHEN c_nationkey = 3 THEN NULL ELSE c_name END",
    "c_mktsegment": "nullif(c_mktsegment, 'BUILDING')",
}


def nulled_sql(day: str) -> str:
    """A day of ``customer`` with nulls in key and value columns."""
    shown = [f"{NULLED[c]} AS {c}" if c in NULLED else c for c in SOURCES["customer"].columns]
    return f"SELECT {', '.join(shown)} FROM ({day})"


def nulled(day: DataFrame) -> DataFrame:
    return day.select(*[F.expr(NULLED.get(c, c)).alias(c) for c in day.columns])
