"""Helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager, nullcontext

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changecapture.session import work_folder

#: Rows that a Python worker takes apart at a time.
SLICE = 256


@contextmanager
def batches_of(spark: SparkSession, size: str):
    """What is executed inside sends its rows to Python in batches of ``size`` bytes, not of 64 MB."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows, a few at a time: as Python objects they take many times their bytes."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def written(df: DataFrame, batch: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there and survives lost executors.

    ``batch`` bounds the bytes that a Python worker takes in at a time.
    """
    path = f"{work_folder(df.sparkSession)}/{uuid.uuid4().hex[:8]}"
    with batches_of(df.sparkSession, batch) if batch else nullcontext():
        df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete ``written`` tables once all that was derived from them is written itself."""
    for table in tables:
        jvm = table.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.written_path)
        conf = table.sparkSession._jsparkSession.sessionState().newHadoopConf()
        path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def name128(value: Column) -> Column:
    """128-bit name of a string or binary: the first half of its SHA-256."""
    return F.substring(F.unhex(F.sha2(value.cast("binary"), 256)), 1, 16)


def shards(df: DataFrame) -> int:
    """Shuffle partitions the session asks for."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def doc_key(id_column: str, text_column: str) -> list[Column]:
    """Identity of a document (its id and a 128-bit name of its text) and its text, null as empty."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return [F.col(id_column).alias("_id"), name128(text).alias("_text"), text.alias("_content")]


def _pack(batches):
    import zstandard

    pack = zstandard.ZstdCompressor(level=3)
    for batch in slices(batches):
        done = [pack.compress(x) for x in batch.column("_bytes").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_text"), pa.array(done, pa.binary())],
            ["_id", "_text", "packed"],
        )


def packed(own: DataFrame) -> DataFrame:
    """``_id, _text, packed`` of ``doc_key`` columns: texts as compressed bytes, to be shuffled."""
    kind, name = (own.schema[c].dataType.simpleString() for c in ("_id", "_text"))
    content = F.col("_content").cast("binary").alias("_bytes")
    return own.select("_id", "_text", content).mapInArrow(
        _pack, f"_id {kind}, _text {name}, packed binary"
    )


def without(
    docs: DataFrame, gone: DataFrame, id_column: str, text_column: str, once: bool = False
) -> DataFrame:
    """``docs`` but for those in ``gone`` (``_id, _text``); with ``once`` one row of an id and text.

    ``docs`` may have any other columns: their names never clash with the ones used here.
    """
    id_, text, _ = doc_key(id_column, text_column)
    taken = {c.lower() for c in docs.columns}
    key = next(k for k in ("_key" + "_" * n for n in range(len(taken) + 1)) if k not in taken)
    gone = gone.select(F.struct("_id", "_text").alias(key))
    rows = docs.select("*", F.struct(id_, text).alias(key))
    kept = rows.join(gone, key, "left_anti")
    return (kept.dropDuplicates([key]) if once else kept).drop(key)


def same_doc(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the identity of a document, whose id may be null."""
    right = right.withColumnsRenamed({"_id": "_rid", "_text": "_rtext"})
    same = left["_id"].eqNullSafe(right["_rid"]) & (left["_text"] == right["_rtext"])
    return left.join(right, same, how).drop("_rid", "_rtext")
