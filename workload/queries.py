"""One query per operator, each over whole given tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import changecapture as cc
from changecapture import columns as C
from changecapture.functions.encoding import encode
from changecapture.functions.hashing import digest
from changecapture.session import work_database, work_folder
from workload.snapshots import SOURCES, nulled, today, tomorrow

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FIRST, SECOND, THIRD = "job-0", "job-1", "job-2"
DAY_ONE, DAY_TWO = "2024-01-01", "2024-01-02"
POINTER_TYPES = T.StructType([T.StructField(n, T.IntegerType()) for n in ("yy", "mn", "dy")])
POINTER_ONE = {"yy": 2024, "mn": 1, "dy": 30}
POINTER_TWO = {"yy": 2024, "mn": 1, "dy": 31}
LIVE_DAYS = ("day-01", "day-10", "day-20")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# -- shared steps ---------------------------------------------------------------------


def _sides(spark, sf_dir, name, **settings):
    """Hashed next snapshot, mirror after the first load, and the second job's settings."""
    source = SOURCES[name]
    first, second = source.config(FIRST, **settings), source.config(SECOND, **settings)
    if not first.inline:
        first = replace(first, partition_values=POINTER_ONE)
        second = replace(second, partition_values=POINTER_TWO)
    hashed = cc.add_hashes(today(spark, sf_dir, name), first)
    mirror = cc.mirror_of(cc.classify(hashed, None, first))
    return cc.add_hashes(tomorrow(spark, sf_dir, name), second), mirror, second


def _classified(spark, sf_dir, name, **settings):
    return cc.classify(*_sides(spark, sf_dir, name, **settings))


def _link_settings():
    return {"inline": False, "partition_columns": "yy,mn,dy"}


def _history(spark, sf_dir):
    """Source history of ``conversations``: two days as partitions of ``<db>.talk_src``."""
    folder = work_folder(spark)
    database = work_database(spark, folder)
    root = f"{folder}/talk_src"
    days = ((POINTER_ONE, today), (POINTER_TWO, tomorrow))
    partitions = []
    for pointer, day in days:
        path = "/".join([root, *[f"{k}={v}" for k, v in pointer.items()]])
        cc.write_dataset(day(spark, sf_dir, "conversations"), path)
        partitions.append((pointer, path))
    schema = today(spark, sf_dir, "conversations").schema
    cc.create_landing(spark, f"{database}.talk_src", schema, root, partitioned_by=POINTER_TYPES)
    cc.add_partitions(spark, f"{database}.talk_src", partitions)
    return f"{database}.talk"


def _link_days(spark, sf_dir):
    """Both days through the link table; the settings and results of the second."""
    table = _history(spark, sf_dir)
    source = SOURCES["conversations"]
    for job, pointer in ((FIRST, POINTER_ONE), (SECOND, POINTER_TWO)):
        cfg = source.config(job, table, partition_values=pointer, **_link_settings())
        result = cc.build_delta(spark, cfg)
    return cfg, result


def _landed_events(spark, sf_dir):
    """``events`` landed by day, and the landing table over it without partitions yet."""
    folder = work_folder(spark)
    database = work_database(spark, folder)
    root, table = f"{folder}/events_src", f"{database}.events_src"
    events = today(spark, sf_dir, "events").withColumn(
        "export_date", F.date_format("ts", "yyyy-MM-dd")
    )
    events.hint("rebalance", "export_date").write.partitionBy("export_date").parquet(root)
    cc.create_landing(spark, table, events.drop("export_date").schema, root)
    # the directories just written; no row is read again
    files = spark.read.parquet(root).inputFiles()
    days = sorted({re.search(r"export_date=([^/]+)/", f)[1] for f in files})
    return table, [({"export_date": d}, f"{root}/export_date={d}") for d in days]


# -- sources --------------------------------------------------------------------------


@query
def read_snapshot(spark, sf_dir):
    return cc.read_snapshot(spark, f"{sf_dir}/customer.parquet")


@query
def read_landing_partition(spark, sf_dir):
    root = work_folder(spark)
    cc.land_partition(today(spark, sf_dir, "orders"), root, DAY_ONE)
    cc.land_partition(tomorrow(spark, sf_dir, "orders"), root, DAY_TWO)
    return cc.read_landing(spark, root, DAY_TWO)


@query
def read_catalog_table(spark, sf_dir):
    table = f"{work_database(spark)}.orders"
    today(spark, sf_dir, "orders").write.format("orc").saveAsTable(table)
    return cc.read_table(spark, table)


# -- sinks and table maintenance ------------------------------------------------------


@query
def write_dataset(spark, sf_dir):
    path = work_folder(spark)
    cc.write_dataset(today(spark, sf_dir, "orders"), path, "orc")
    cc.write_dataset(today(spark, sf_dir, "events"), path, "orc")
    return cc.read_snapshot(spark, path, "orc")


@query
def land_partition(spark, sf_dir):
    root = work_folder(spark)
    cc.land_partition(today(spark, sf_dir, "orders"), root, DAY_ONE)
    cc.land_partition(today(spark, sf_dir, "orders"), root, DAY_TWO)
    cc.land_partition(tomorrow(spark, sf_dir, "orders"), root, DAY_ONE)
    days = [cc.read_landing(spark, root, day) for day in (DAY_ONE, DAY_TWO)]
    return days[0].unionByName(days[1])


@query
def append_delta(spark, sf_dir):
    rows = cc.delta_of(_classified(spark, sf_dir, "orders", table_type="fact"))
    table = f"{work_database(spark)}.orders"
    cc.append_delta(rows, table, SECOND)
    return spark.table(cc.append_delta(rows, table, SECOND))


@query
def write_mirror(spark, sf_dir):
    rows = cc.mirror_of(_classified(spark, sf_dir, "customer"))
    return spark.table(cc.write_mirror(rows, f"{work_database(spark)}.customer", SECOND))


@query
def swap_mirror(spark, sf_dir):
    new, mirror, cfg = _sides(spark, sf_dir, "customer")
    table = f"{work_database(spark)}.customer"
    cc.write_mirror(mirror, table, FIRST)
    cc.swap_mirror(spark, table, FIRST)
    cc.write_mirror(cc.classify(new, spark.table(table), cfg), table, SECOND)
    cc.swap_mirror(spark, table, SECOND)
    return spark.table(table)


@query
def add_partition(spark, sf_dir):
    table, partitions = _landed_events(spark, sf_dir)
    cc.add_partitions(spark, table, partitions)
    for spec, path in partitions[:1]:
        cc.add_partition(spark, table, spec, path)
    return spark.table(table)


@query
def drop_partition(spark, sf_dir):
    table, partitions = _landed_events(spark, sf_dir)
    cc.add_partitions(spark, table, partitions)
    cc.drop_partition(spark, table, partitions[0][0])
    return spark.table(table)


@query
def list_partitions(spark, sf_dir):
    table, partitions = _landed_events(spark, sf_dir)
    cc.add_partitions(spark, table, partitions)
    return cc.list_partitions(spark, table)


# -- schema and catalog objects -------------------------------------------------------


def _filled(created: T.StructType, loaded: DataFrame) -> DataFrame:
    """Columns as the DDL made them, and how many rows of a first load have a value there."""
    counts = loaded.agg(*[F.count(c).alias(c) for c in loaded.columns])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            (F.col(f.name) if f.name in loaded.columns else F.lit(None).cast("bigint")).alias("filled"),
        )
        for i, f in enumerate(created.fields, 1)
    ]
    return counts.select(F.inline(F.array(*rows)))


@query
def create_mirror(spark, sf_dir):
    cfg = SOURCES["customer"].config(FIRST, f"{work_database(spark)}.customer")
    snapshot = today(spark, sf_dir, "customer")
    cc.create_mirror(spark, cfg, snapshot.schema)
    created = spark.table(cfg.mirror_name + "__init").schema
    return _filled(created, cc.build_delta(spark, cfg, snapshot).mirror)


@query
def create_link(spark, sf_dir):
    table = _history(spark, sf_dir)
    cfg = SOURCES["conversations"].config(
        FIRST, table, partition_values=POINTER_ONE, **_link_settings()
    )
    cc.create_link(spark, cfg, spark.table(f"{table}_src").schema)
    created = spark.table(cfg.mirror_name + "__init").schema
    return _filled(created, cc.build_delta(spark, cfg).mirror)


@query
def link_view(spark, sf_dir):
    cfg, _ = _link_days(spark, sf_dir)
    cc.link_view(spark, cfg)
    return spark.table(cfg.table)


@query
def link_view_live(spark, sf_dir):
    """Thirty days of history, of which three were run: the view reads the partitions in use."""
    folder = work_folder(spark)
    table, root = f"{work_database(spark, folder)}.supplier", f"{folder}/supplier_src"
    days = [f"day-{n:02}" for n in range(1, 31)]
    name = F.concat("s_name", F.lit("*"), F.least("day", "s_nationkey").cast("string"))
    supplier = today(spark, sf_dir, "supplier")
    history = supplier.select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(days)))).alias("day")
    ).withColumn("s_name", name)
    history = history.withColumn("export_date", F.format_string("day-%02d", "day")).drop("day")
    history.hint("rebalance", "export_date").write.partitionBy("export_date").parquet(root)
    cc.create_landing(spark, f"{table}_src", supplier.schema, root)
    cc.add_partitions(
        spark, f"{table}_src", [({"export_date": d}, f"{root}/export_date={d}") for d in days]
    )
    for day in LIVE_DAYS:
        cc.build_delta(spark, SOURCES["supplier"].config(day, table, inline=False))
    return spark.table(table)


@query
def create_landing_table(spark, sf_dir):
    table = f"{_history(spark, sf_dir)}_src"
    return spark.table(table)


@query
def project_ids(spark, sf_dir):
    source = SOURCES["lineitem"]
    return cc.project(today(spark, sf_dir, "lineitem"), source.config(FIRST), "ids")


@query
def project_payload_bare(spark, sf_dir):
    source = SOURCES["lineitem"]
    return cc.project(today(spark, sf_dir, "lineitem"), source.config(FIRST), "payload_bare")


@query
def project_hashable(spark, sf_dir):
    source = SOURCES["orders"]
    return cc.project(today(spark, sf_dir, "orders"), source.config(FIRST), "payload_hashex")


@query
def project_payload_metaex(spark, sf_dir):
    rows = _classified(spark, sf_dir, "customer")
    return cc.project(rows, SOURCES["customer"].config(FIRST), "payload_metaex")


# -- projections and row transforms ---------------------------------------------------


@query
def narrow(spark, sf_dir):
    return cc.narrow(today(spark, sf_dir, "lineitem"), SOURCES["lineitem"].config(FIRST))


@query
def unwrap_fields(spark, sf_dir):
    part = today(spark, sf_dir, "part")
    wrapped = part.select(
        "p_partkey",
        *[
            F.struct(F.col(c).alias("value"), F.lit(DAY_ONE).alias("seen")).alias(c)
            for c in part.columns[1:-1]
        ],
        F.struct(F.col(part.columns[-1]).alias("amount")).alias(part.columns[-1]),
    )
    path = work_folder(spark)
    cc.write_dataset(wrapped, path)
    out = cc.unwrap(cc.read_snapshot(spark, path))
    return out.withColumn(part.columns[-1], F.col(part.columns[-1]).getField("amount"))


@query
def key_hash(spark, sf_dir):
    df = today(spark, sf_dir, "lineitem")
    keys = SOURCES["lineitem"].keys
    return df.select(*keys, cc.key_hash(df, keys).alias(C.KEY_HASH))


@query
def value_hash(spark, sf_dir):
    df = today(spark, sf_dir, "lineitem")
    keys = SOURCES["lineitem"].keys
    return df.select(*keys, cc.value_hash(df, keys).alias(C.VALUE_HASH))


@query
def value_hash_exclusions(spark, sf_dir):
    df, source = tomorrow(spark, sf_dir, "orders"), SOURCES["orders"]
    hashed = cc.value_hash(df, source.keys, source.excluded)
    return df.select(*source.keys, hashed.alias(C.VALUE_HASH))


@query
def hash_md5(spark, sf_dir):
    df = today(spark, sf_dir, "events")
    return df.select("event_id", digest(encode(df.schema.fields), "md5").alias("digest"))


@query
def hash_sha(spark, sf_dir):
    df = today(spark, sf_dir, "documents")
    return df.select("doc_id", digest(encode(df.schema.fields), "sha").alias("digest"))


@query
def hash_murmur(spark, sf_dir):
    return _classified(spark, sf_dir, "customer", hash_kind="murmur").select("c_custkey", C.ACT)


@query
def hash_xxhash(spark, sf_dir):
    return _classified(spark, sf_dir, "orders", hash_kind="xxhash").select("o_orderkey", C.ACT)


@query
def add_hashes_inline(spark, sf_dir):
    return cc.add_hashes(today(spark, sf_dir, "orders"), SOURCES["orders"].config(FIRST))


@query
def add_hashes_link(spark, sf_dir):
    cfg = SOURCES["conversations"].config(FIRST, inline=False)
    return cc.add_hashes(today(spark, sf_dir, "conversations"), cfg)


@query
def mutate_snapshot(spark, sf_dir):
    source = SOURCES["part"]
    return cc.mutate(today(spark, sf_dir, "part"), source.keys, source.excluded, seed="7")


# -- joins ----------------------------------------------------------------------------


@query
def outer_join_keys(spark, sf_dir):
    pairs = cc.outer_join_keys(*_sides(spark, sf_dir, "orders"))
    return pairs.select(*[f"{side}_{name}" for side in ("new", "old") for name in C.HASHES])


def _narrow_changes(spark, sf_dir):
    new, mirror, cfg = _sides(spark, sf_dir, "orders")
    changes = cc.classify(new, mirror, cfg).select(*C.DIM_LINEAGE, *C.HASHES)
    return changes, new, mirror, cfg


@query
def attach_new_payload(spark, sf_dir):
    changes, new, _, cfg = _narrow_changes(spark, sf_dir)
    return cc.attach_new_payload(changes, new, cfg)


@query
def attach_old_payload(spark, sf_dir):
    changes, _, mirror, cfg = _narrow_changes(spark, sf_dir)
    return cc.attach_old_payload(changes, mirror, cfg)


# -- classification -------------------------------------------------------------------


@query
def classify_changes(spark, sf_dir):
    return _classified(spark, sf_dir, "orders").select("o_orderkey", C.KEY_HASH, C.ACT)


@query
def dim_delta(spark, sf_dir):
    return cc.extract_delta(*_sides(spark, sf_dir, "customer"))[0]


@query
def dim_mirror(spark, sf_dir):
    return cc.extract_delta(*_sides(spark, sf_dir, "customer"))[1]


@query
def fact_delta(spark, sf_dir):
    return cc.extract_delta(*_sides(spark, sf_dir, "orders", table_type="fact"))[0]


@query
def fact_mirror(spark, sf_dir):
    return cc.extract_delta(*_sides(spark, sf_dir, "orders", table_type="fact"))[1]


@query
def assign_surrogate_key(spark, sf_dir):
    return _classified(spark, sf_dir, "customer").select("c_custkey", C.NK, C.ACT)


@query
def partition_carry(spark, sf_dir):
    rows = _classified(spark, sf_dir, "conversations", **_link_settings())
    return rows.select("conv_id", "turn", C.ACT, *POINTER_TWO)


# -- predicates -----------------------------------------------------------------------


@query
def changes_new_side(spark, sf_dir):
    return cc.new_side(_classified(spark, sf_dir, "customer"))


@query
def changes_old_side(spark, sf_dir):
    return cc.old_side(_classified(spark, sf_dir, "customer"))


@query
def inserted(spark, sf_dir):
    return cc.inserted(_classified(spark, sf_dir, "orders"))


@query
def updated(spark, sf_dir):
    return cc.updated(_classified(spark, sf_dir, "orders"))


@query
def deleted(spark, sf_dir):
    return cc.deleted(_classified(spark, sf_dir, "orders"))


@query
def stationary(spark, sf_dir):
    return cc.stationary(_classified(spark, sf_dir, "orders"))


# -- whole runs -----------------------------------------------------------------------


@query
def build_delta_inline(spark, sf_dir):
    cfg = SOURCES["orders"].config(FIRST, f"{work_database(spark)}.orders")
    cc.build_delta(spark, cfg, today(spark, sf_dir, "orders"))
    second = replace(cfg, job_id=SECOND)
    return cc.build_delta(spark, second, tomorrow(spark, sf_dir, "orders")).delta


def _two_days(spark, name, days, **settings):
    """Delta of the second of two runs."""
    cfg = SOURCES[name].config(FIRST, f"{work_database(spark)}.{name}", **settings)
    for job, day in zip((FIRST, SECOND), days, strict=True):
        result = cc.build_delta(spark, replace(cfg, job_id=job), day)
    return result.delta


def _days(spark, sf_dir, name):
    return today(spark, sf_dir, name), tomorrow(spark, sf_dir, name)


@query
def build_delta_reordered(spark, sf_dir):
    first, second = _days(spark, sf_dir, "orders")
    moved = [*second.columns[3:], *reversed(second.columns[:3])]
    return _two_days(spark, "orders", (first, second.select(*moved)))


@query
def build_delta_narrow_first(spark, sf_dir):
    return _two_days(spark, "orders", _days(spark, sf_dir, "orders"), narrow_first=True)


@query
def build_delta_fact(spark, sf_dir):
    return _two_days(spark, "orders", _days(spark, sf_dir, "orders"), table_type="fact")


@query
def build_delta_copy_on_write(spark, sf_dir):
    days = _days(spark, sf_dir, "orders")
    return _two_days(spark, "orders", days, table_type="fact", copy_on_write=True)


@query
def copy_on_write_mirror(spark, sf_dir):
    """The third run changes nothing, so its version takes over every directory."""
    cfg = SOURCES["orders"].config(
        FIRST, f"{work_database(spark)}.orders", table_type="fact", copy_on_write=True
    )
    days = _days(spark, sf_dir, "orders")
    for job, day in ((FIRST, days[0]), (SECOND, days[1]), (THIRD, days[1])):
        result = cc.build_delta(spark, replace(cfg, job_id=job), day)
    return result.mirror


@query
def build_delta_digests(spark, sf_dir):
    days = _days(spark, sf_dir, "orders")
    return _two_days(spark, "orders", days, narrow_first=True, digest_buckets=4096)


@query
def bucket_digests(spark, sf_dir):
    new, mirror, _ = _sides(spark, sf_dir, "customer")
    return cc.differing(cc.digests(new, 4096), cc.digests(mirror, 4096))


@query
def build_delta_buckets(spark, sf_dir):
    return _two_days(spark, "customer", _days(spark, sf_dir, "customer"), buckets=8)


@query
def build_delta_keep_first(spark, sf_dir):
    days = _days(spark, sf_dir, "lineitem")
    return _two_days(
        spark, "lineitem", days, on_duplicates="keep_first", dedupe_order="l_shipdate"
    )


@query
def build_delta_nulls(spark, sf_dir):
    days = [nulled(day) for day in _days(spark, sf_dir, "customer")]
    return _two_days(spark, "customer", days)


@query
def build_delta_link_default(spark, sf_dir):
    """The partition of each day is found by the job id alone."""
    folder = work_folder(spark)
    table, root = f"{work_database(spark, folder)}.talk", f"{folder}/talk_src"
    days = _days(spark, sf_dir, "conversations")
    cc.create_landing(spark, f"{table}_src", days[0].schema, root)
    for job, day in zip((FIRST, SECOND), days, strict=True):
        cc.add_partition(
            spark, f"{table}_src", {"export_date": job}, cc.land_partition(day, root, job)
        )
        result = cc.build_delta(spark, SOURCES["conversations"].config(job, table, inline=False))
    return result.delta


@query
def build_delta_link(spark, sf_dir):
    return _link_days(spark, sf_dir)[1].delta


@query
def run_batch(spark, sf_dir):
    folder = work_folder(spark)
    database = work_database(spark, folder)
    names = ("region", "nation", "supplier", "part")
    for job, day, snapshot in ((FIRST, DAY_ONE, today), (SECOND, DAY_TWO, tomorrow)):
        steps = [
            cc.DeltaStep(
                SOURCES[name].config(job, f"{database}.{name}"),
                lambda s, name=name, snapshot=snapshot: snapshot(s, sf_dir, name),
                f"{folder}/landing/{name}",
                day,
            )
            for name in names
        ]
        steps.append(
            cc.PartitionStep(
                f"{database}.events_src",
                lambda s: today(s, sf_dir, "events"),
                f"{folder}/landing/events",
                day,
            )
        )
        done = cc.run_batch(spark, steps)
    out = done[f"{database}.events_src"].select(
        F.lit("events").alias("tbl"),
        F.col("event_id").cast("string").alias("key"),
        F.col("export_date").alias("mark"),
        F.lit(None).cast("string").alias("nk"),
    )
    for name in names:
        rows = done[f"{database}.{name}"].delta.select(
            F.lit(name).alias("tbl"),
            F.col(SOURCES[name].keys[0]).cast("string").alias("key"),
            F.col(C.ACT).alias("mark"),
            F.col(C.NK).alias("nk"),
        )
        out = out.unionByName(rows)
    return out


def _three_days(spark, sf_dir, replay, compact=False, jobs=None):
    cfg = SOURCES["customer"].config(FIRST, f"{work_database(spark)}.customer")
    days = [
        (FIRST, today(spark, sf_dir, "customer")),
        (SECOND, tomorrow(spark, sf_dir, "customer")),
        (THIRD, today(spark, sf_dir, "customer")),
    ]
    replay(spark, cfg, days)
    if compact:
        cc.compact_delta(spark, cfg, "period-0")
        cc.drop_rolled(spark, cfg)
    return cc.read_delta(spark, cfg, jobs).select(
        C.JOB, C.ACT, C.NK, "c_custkey", "c_mktsegment", "c_acctbal"
    )


@query
def replay_days(spark, sf_dir):
    return _three_days(spark, sf_dir, cc.replay)


@query
def replay_at_once(spark, sf_dir):
    return _three_days(spark, sf_dir, cc.replay_at_once)


@query
def compact_delta(spark, sf_dir):
    """The first two of three days are rolled into a period; the view shows all three."""
    return _three_days(spark, sf_dir, cc.replay, compact=True)


@query
def read_delta_rolled(spark, sf_dir):
    """One rolled job and the open one, found by the statistics of the jobs."""
    return _three_days(spark, sf_dir, cc.replay, compact=True, jobs=(SECOND, THIRD))


@query
def job_statistics(spark, sf_dir):
    cfg = SOURCES["orders"].config(FIRST, f"{work_database(spark)}.orders", table_type="fact")
    first, second = _days(spark, sf_dir, "orders")
    for job, day in ((FIRST, first), (SECOND, second), (THIRD, second)):
        cc.build_delta(spark, replace(cfg, job_id=job), day)
    cc.compact_delta(spark, cfg, "period-0")
    return cc.job_statistics(spark, cfg)


@query
def build_delta_landed(spark, sf_dir):
    """Both days land hashed, in the buckets of the mirror."""
    cfg = SOURCES["customer"].config(FIRST, f"{work_database(spark)}.customer", buckets=8)
    for job, day in zip((FIRST, SECOND), _days(spark, sf_dir, "customer"), strict=True):
        own = replace(cfg, job_id=job)
        landed = cc.land_hashed(spark, own, day)
        result = cc.build_delta(spark, own, hashed=spark.table(landed))
    return result.delta


# -- guards ---------------------------------------------------------------------------


@query
def duplicate_keys(spark, sf_dir):
    return cc.duplicate_keys(today(spark, sf_dir, "lineitem"), SOURCES["lineitem"].keys)


@query
def dedupe_snapshot(spark, sf_dir):
    return cc.dedupe(today(spark, sf_dir, "lineitem"), SOURCES["lineitem"].keys, "l_shipdate")


@query
def action_counts(spark, sf_dir):
    return cc.action_counts(cc.delta_of(_classified(spark, sf_dir, "orders")))
