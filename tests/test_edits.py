"""Known label counts on given tables, and the rules every run obeys."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from changecapture import (
    TableConfig,
    add_hashes,
    attach_new_payload,
    attach_old_payload,
    build_delta,
    classify,
    delta_of,
    extract_delta,
    mirror_of,
    mutate,
)


def edited(df, key, changed, excluded):
    """A smaller and a rewritten copy of a table, by remainders of its key."""
    k = F.col(key)
    old = df.where(k % 11 != 0)
    new = df.where(k % 13 != 0).select(
        *[
            F.when(k % 7 == 0, F.concat(c, F.lit("*"))).otherwise(F.col(c)).alias(c)
            if c == changed
            else F.when(k % 5 == 0, F.col(c) + 1).otherwise(F.col(c)).alias(c)
            if c == excluded
            else F.col(c)
            for c in df.columns
        ]
    )
    return old, new


CUSTOMER = ("customer", "dim", "c_custkey", "c_mktsegment", "c_acctbal", (126, 180, 105, 1078))
ORDERS = (
    "orders", "fact", "o_orderkey", "o_orderstatus", "o_totalprice", (1259, 1798, 1049, 10789),
)


@pytest.mark.parametrize(
    "edit,kind",
    [*[(CUSTOMER, k) for k in ("md5", "sha", "murmur", "xxhash")], (ORDERS, "md5")],
)
def test_label_counts(spark, data, edit, kind):
    table, table_type, key, changed, excluded, counts = edit
    df = spark.read.parquet(f"{data}/{table}.parquet")
    old, new = edited(df, key, changed, excluded)
    cfg = TableConfig(
        table, key, table_type=table_type, exclusions=excluded, hash_kind=kind, job_id="j0"
    )
    mirror = mirror_of(classify(add_hashes(old, cfg), None, cfg))
    rows = classify(add_hashes(new, cfg), mirror, replace(cfg, job_id="j1"))
    found = {r.DWSACT: r["count"] for r in rows.groupBy("DWSACT").count().collect()}
    assert tuple(found[a] for a in "IUDS") == counts


def test_excluded_columns_keep_old_values_on_unchanged_rows(spark):
    cfg = TableConfig("t", "id", exclusions="seen", job_id="j0")
    schema = "id int, v string, seen int"
    old = add_hashes(spark.createDataFrame([(1, "a", 1), (2, "a", 1)], schema), cfg)
    mirror = mirror_of(classify(old, None, cfg))
    new = add_hashes(spark.createDataFrame([(1, "a", 2), (2, "b", 2)], schema), cfg)
    rows = {r.id: r for r in classify(new, mirror, replace(cfg, job_id="j1")).collect()}
    assert (rows[1].DWSACT, rows[1].seen) == ("S", 1)
    assert (rows[2].DWSACT, rows[2].seen) == ("U", 2)


def test_nulls_are_values_and_a_null_key_is_a_key(spark):
    cfg = TableConfig("t", "a,b", job_id="j0")
    schema = "a string, b string, v string"
    old = add_hashes(
        spark.createDataFrame([(None, "x", None), ("x", None, ""), (None, None, "v")], schema), cfg
    )
    mirror = mirror_of(classify(old, None, cfg))
    new = add_hashes(
        spark.createDataFrame([(None, "x", ""), ("x", None, ""), (None, None, "v")], schema), cfg
    )
    rows = classify(new, mirror, replace(cfg, job_id="j1")).collect()
    found = {(r.a, r.b): r.DWSACT for r in rows}
    assert found == {(None, "x"): "U", ("x", None): "S", (None, None): "S"}


def brute_force(old, new):
    out = {}
    for k in old.keys() | new.keys():
        if k not in old:
            out[k] = "I"
        elif k not in new:
            out[k] = "D"
        else:
            out[k] = "S" if old[k] == new[k] else "U"
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("kind", ["md5", "murmur"])
def test_random_snapshots_against_brute_force(spark, seed, kind):
    rng = random.Random(seed)
    values = ["", None, "a", "a;", ";a", "~", "1:a", "é", "a" * 50]

    def snapshot():
        return {
            (rng.randrange(40), rng.choice(["x", "", None])): tuple(rng.choices(values, k=2))
            for _ in range(60)
        }

    old, new = snapshot(), snapshot()
    for k in list(old)[::2]:
        new[k] = old[k]
    cfg = TableConfig("t", "k,l", hash_kind=kind, job_id="j0")
    frame = lambda s: spark.createDataFrame(
        [(*k, *v) for k, v in s.items()], "k int, l string, v string, w string"
    )
    mirror = mirror_of(classify(add_hashes(frame(old), cfg), None, cfg))
    rows = classify(add_hashes(frame(new), cfg), mirror, replace(cfg, job_id="j1")).collect()
    assert {(r.k, r.l): r.DWSACT for r in rows} == brute_force(old, new)
    for r in rows:
        side = old if r.DWSACT in "DS" else new
        assert (r.v, r.w) == side[r.k, r.l]


def test_rules_of_every_run(spark, data, db):
    base = spark.read.parquet(f"{data}/part.parquet")
    changed = mutate(base, "p_partkey", "p_retailprice", seed="1")
    mixed = base.where("p_size < 30").unionByName(changed.where("p_size % 2 = 0 and p_partkey > 0"))
    mixed = mixed.dropDuplicates(["p_partkey"])
    snapshots = [("a", base), ("b", mixed), ("c", mixed), ("d", changed)]
    cfg = TableConfig(f"{db}.part", "p_partkey", exclusions="p_retailprice")
    before, keys = None, {}
    for job, snapshot in snapshots:
        result = build_delta(spark, replace(cfg, job_id=job), snapshot)
        n = result.counts
        assert n["I"] + n["U"] + n["S"] == snapshot.count()
        after = {r.p_partkey: r for r in result.mirror.collect()}
        if before is not None:
            assert n["D"] + n["U"] + n["S"] == len(before)
            # old mirror less D, with I and U put on top, is the new mirror
            rebuilt = dict(before)
            for r in result.delta.collect():
                if r.DWSACT == "D":
                    del rebuilt[r.p_partkey]
                else:
                    rebuilt[r.p_partkey] = r
            show = lambda r: (r.NK, r.DWSVALHASH, r.p_name, r.p_retailprice)
            assert {k: show(r) for k, r in rebuilt.items()} == {
                k: show(r) for k, r in after.items()
            }
            assert all(after[k].NK == nk for k, nk in keys.items() if k in after)
        if job == "c":
            assert result.delta.count() == 0
        before, keys = after, {k: r.NK for k, r in after.items()}


def test_mutate_keeps_keys_types_and_excluded_columns(spark, data):
    base = spark.read.parquet(f"{data}/part.parquet")
    out = mutate(base, "P_PARTKEY", "p_retailprice", seed="1")
    assert out.dtypes == base.dtypes
    both = base.alias("a").join(out.alias("b"), "p_partkey")
    assert both.count() == base.count()
    assert both.where("a.p_retailprice <> b.p_retailprice").count() == 0
    assert both.where("a.p_name = b.p_name or a.p_brand = b.p_brand").count() == 0
    assert out.where("length(p_name) <> 20").count() == 0
    again = mutate(base.repartition(5), "p_partkey", "p_retailprice", "1")
    assert out.exceptAll(again).count() == 0
    other = mutate(base, "p_partkey", "p_retailprice", seed="2")
    assert out.join(other, ["p_partkey", "p_name"]).count() == 0


def test_mutate_covers_numbers(spark):
    df = spark.sql(
        "select 1 id, cast(1 as tinyint) a, cast(1 as smallint) b, 1L c, cast(1 as float) d, 1d e, "
        "cast(1 as decimal(9,2)) f, cast(1 as decimal(2,2) ) g, date'2024-01-01' h "
        "where false union all select 2, 1Y, 1S, 1L, float(1), 1d, cast(1 as decimal(9,2)), "
        "cast(0.5 as decimal(2,2)), date'2024-01-01'"
    )
    out = mutate(df, "id")
    assert out.dtypes == df.dtypes
    assert out.count() == 1


@pytest.mark.parametrize("kind", ["md5", "murmur"])
def test_payload_comes_back_by_key(spark, kind):
    schema = "k string, l int, v string"
    old = spark.createDataFrame([("a", 1, "x"), (None, 2, "y"), ("c", 3, "z")], schema)
    new = spark.createDataFrame([("a", 1, "x"), (None, 2, "w"), ("d", 4, "u")], schema)
    cfg = TableConfig("t", "k,l", hash_kind=kind, job_id="j0")
    mirror = mirror_of(classify(add_hashes(old, cfg), None, cfg))
    hashed = add_hashes(new, cfg)
    second = replace(cfg, job_id="j1")
    full = classify(hashed, mirror, second)
    narrow = full.drop("v")
    both = attach_new_payload(narrow, hashed, second).unionByName(
        attach_old_payload(narrow, mirror, second)
    )
    assert both.columns == full.columns
    assert both.count() == full.count() == 4
    assert both.exceptAll(full).count() == 0


def test_extract_delta_splits_one_plan(spark, data):
    df = spark.read.parquet(f"{data}/customer.parquet")
    old, new = edited(df, "c_custkey", "c_mktsegment", "c_acctbal")
    cfg = TableConfig("customer", "c_custkey", exclusions="c_acctbal", job_id="j0")
    _, mirror = extract_delta(add_hashes(old, cfg), None, cfg)
    delta, renewed = extract_delta(add_hashes(new, cfg), mirror, replace(cfg, job_id="j1"))
    assert delta.count() == 126 + 180 + 105
    assert renewed.count() == new.count()
    assert delta_of(delta).count() == delta.count()


@pytest.mark.parametrize("kind", ["murmur", "xxhash"])
def test_colliding_short_hashes_do_not_mix_keys_up(spark, kind):
    """Among 300,000 keys some share a 32-bit hash; labels and surrogate keys stay right."""
    rows = spark.range(300000).select("id", F.lit("a").alias("v"))
    cfg = TableConfig("t", "id", hash_kind=kind, job_id="j0")
    hashed = add_hashes(rows, cfg)
    if kind == "murmur":
        assert hashed.select("DWSKEYHASH").distinct().count() < 300000
    mirror = mirror_of(classify(hashed, None, cfg))
    assert mirror.select("NK").distinct().count() == 300000
    new = add_hashes(rows.where("id >= 100").withColumn("v", F.expr("if(id < 300, 'b', v)")), cfg)
    labelled = classify(new, mirror, replace(cfg, job_id="j1"))
    found = {r.DWSACT: r["count"] for r in labelled.groupBy("DWSACT").count().collect()}
    assert found == {"D": 100, "U": 200, "S": 299700}


def test_array_columns(spark, data, db):
    base = spark.read.parquet(f"{data}/embeddings.parquet")
    flipped = F.transform("embedding", lambda x: -x)
    changed = base.withColumn(
        "embedding", F.when(F.col("vec_id") < 10, flipped).otherwise(F.col("embedding"))
    )
    cfg = TableConfig(f"{db}.vectors", "vec_id", job_id="d1")
    build_delta(spark, cfg, base)
    result = build_delta(spark, replace(cfg, job_id="d2"), changed)
    assert result.counts == {"I": 0, "U": 10, "D": 0, "S": base.count() - 10}
    shown = result.mirror.select(*base.columns)
    assert shown.exceptAll(changed).count() == 0
