"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   data (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated query names (default: the headline queries and the runs below)
BENCH_ROWS     rows of the made-up table of these runs (default 1,000,000)

Every query runs once to warm up and then BENCH_RUNS times (default 2); the median is
reported. Shuffle bytes come from Spark's event log.

Besides, the next day of a made-up table with wide rows, of which 3% change, is run three ways:
plain, with ``narrow_first``, and with ``buckets``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from dataclasses import replace
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from changecapture import TableConfig, build_delta  # noqa: E402
from changecapture.session import SETTINGS, drop_work_databases, work_database  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

# headline query -> the table its rows are counted in
HEADLINE = {
    "dim_delta": "customer",
    "dim_mirror": "customer",
    "fact_delta": "orders",
    "fact_mirror": "orders",
    "build_delta_inline": "orders",
    "build_delta_link": "conversations",
    "replay_days": "customer",
    "run_batch": "part",
    "key_hash": "lineitem",
    "value_hash": "lineitem",
    "duplicate_keys": "lineitem",
    "dedupe_snapshot": "lineitem",
    "hash_sha": "documents",
}


RUNS = {"wide_plain": {}, "wide_narrow_first": {"narrow_first": True}, "wide_buckets": {"buckets": 8}}


def wide_day(spark: SparkSession, rows: int, day: int):
    """Ten columns of text a row; a day rewrites every 33rd row."""
    text = [F.md5(F.concat_ws("-", "id", F.lit(i))).alias(f"c{i}") for i in range(9)]
    changed = F.when(F.col("id") % 33 == day % 33, F.lit(day)).otherwise(0)
    return spark.range(rows).select("id", *text, changed.alias("mark"))


def run_wide(spark: SparkSession, name: str, rows: int, days: int) -> float:
    """Median seconds of the days after the first load."""
    cfg = TableConfig(f"{work_database(spark)}.{name}", "id", job_id="d0", **RUNS[name])
    build_delta(spark, cfg, wide_day(spark, rows, 0))
    times = []
    for day in range(1, days + 1):
        start = time.perf_counter()
        build_delta(spark, replace(cfg, job_id=f"d{day}"), wide_day(spark, rows, day))
        times.append(time.perf_counter() - start)
    return statistics.median(times)


def session(cpus: str, log_dir: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", f"{log_dir}-shared")
        .config("spark.sql.warehouse.dir", f"{log_dir}-warehouse")
        .config("spark.driver.memory", "12g")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.eventLog.dir", f"file:{log_dir}")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run_once(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def shuffle_bytes(log_dir: str, spans: dict[str, tuple[float, float]]) -> dict[str, int]:
    """Bytes written to shuffles by the tasks that ended within each query's span."""
    out = dict.fromkeys(spans, 0)
    for path in Path(log_dir).glob("*"):
        with path.open() as lines:
            for line in lines:
                if '"SparkListenerTaskEnd"' not in line:
                    continue
                event = json.loads(line)
                ended = event["Task Info"]["Finish Time"] / 1000
                written = (event.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
                for name, (start, stop) in spans.items():
                    if start <= ended <= stop:
                        out[name] += written.get("Shuffle Bytes Written", 0)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join([*HEADLINE, *RUNS])).split(",") if n]
    log_dir = tempfile.mkdtemp(prefix="bench-log-")
    spark = session(cpus, log_dir)
    seconds, rows, spans = {}, {}, {}
    for name in names:
        if name in RUNS:
            started = time.time()
            size = int(os.environ.get("BENCH_ROWS", "1000000"))
            seconds[name] = round(run_wide(spark, name, size, runs), 3)
            rows[name], spans[name] = size, (started, time.time())
            continue
        run_once(spark, name, sf_dir)
        times = []
        for _ in range(runs):
            started = time.time()
            times.append(run_once(spark, name, sf_dir))
            spans[name] = (started, time.time())
        seconds[name] = round(statistics.median(times), 3)
        if name in HEADLINE:
            rows[name] = spark.read.parquet(f"{sf_dir}/{HEADLINE[name]}.parquet").count()
    drop_work_databases(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": {n: round(rows[n] / seconds[n]) for n in rows},
                "shuffle_bytes": shuffle_bytes(log_dir, spans),
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
