"""Exact duplicates by recipes of content-defined chunks (DataFrame functions only).

A text is cut where its content says so (after a sentence or line end, between a smallest
and a largest length). Chunks are deduplicated to verified identifiers: a chunk is named by
its SHA-256, every distinct chunk text is compared under its name, and chunks that share a
name without being equal get different numbers. A document is then the ordered list of its
identifiers, and only these lists are grouped. Each text is moved once, as distinct chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changecapture.llm.common import written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Characters of a chunk: it ends at the first sentence or line end after the smallest length.
SMALLEST, LARGEST = 1024, 8192
#: Rows of one id and text that are made in a step.
COPIES = 4096


def normalised(text: Column) -> Column:
    """Null counts as empty; only A-Z are lower-cased."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def chunks_of(text: Column, smallest: int = SMALLEST, largest: int = LARGEST) -> Column:
    """Array of chunks that concatenate to the text; empty for an empty text."""
    pattern = rf"(?s).{{{smallest},{largest}}}?[\n.!?]|.{{1,{largest}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def exact_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk_name=lambda chunk: F.unhex(F.sha2(chunk, 256)),
    each_row: bool = False,
) -> DataFrame:
    """Group documents of equal normalised text; the largest id of a group stays.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256, n_chunks``, one row per
    document. Null texts are empty texts, and empty texts are equal to each other. Rows with
    the same id and text are one document (with ``each_row`` one each, as many as there are,
    counted and returned, of which one is kept); the same id with other texts are several. A null
    id is smaller than any other. Other columns are ignored. ``chunk_name`` may be any
    function of a chunk: names need not be free of collisions.
    """
    texts = docs.select(
        F.col(id_column).alias("doc_id"), normalised(F.col(text_column)).alias("text")
    )
    rows = texts.select(
        "doc_id",
        F.sha2("text", 256).alias("text_sha256"),
        F.posexplode_outer(chunks_of(F.col("text"))).alias("at", "chunk"),
    ).withColumn("name", chunk_name(F.col("chunk")))

    chunks = rows.where("chunk is not null").select("name", "chunk")
    # names of unequal chunks: practically none, so a table of known, tiny size, and no chunk
    # is moved again for the join with it
    shared = written(
        chunks.distinct().groupBy("name").count().where("count > 1").select("name")
    )
    numbered = written(
        chunks.join(shared, "name")
        .distinct()
        .withColumn("number", F.row_number().over(Window.partitionBy("name").orderBy("chunk")))
    )

    recipes = (
        rows.join(numbered, ["name", "chunk"], "left")
        .groupBy("doc_id", "text_sha256")
        .agg(
            F.sort_array(F.collect_set(F.struct("at", "name", "number"))).alias("parts"),
            F.count_if(F.coalesce("at", F.lit(0)) == 0).alias("copies"),
        )
        .select(
            "doc_id",
            "text_sha256",
            F.transform("parts", lambda p: F.struct(p["name"], p["number"])).alias("recipe"),
            F.size(F.filter("parts", lambda p: p["name"].isNotNull())).alias("n_chunks"),
            (F.col("copies") if each_row else F.lit(1)).cast("long").alias("copies"),
        )
    )
    recipes = written(recipes)
    # a table of its own, so that a recipe of very many documents can be split in the join
    groups = written(
        recipes.groupBy("recipe")
        .agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
        .where("group_size > 1")
    )
    grouped = recipes.join(groups, "recipe", "left")
    first = F.lit(True)
    if each_row:
        # in two steps, so that no array grows with the number of copies
        blocks = F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES))
        left = F.least(F.lit(COPIES), F.col("copies") - F.col("block") * COPIES)
        grouped = grouped.withColumn("block", F.explode(blocks)).withColumn(
            "copy", F.explode(F.sequence(F.lit(1), left.cast("int")))
        )
        first = (F.col("block") == 0) & (F.col("copy") == 1)
    return grouped.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id"))
        .otherwise(F.col("keep_id"))
        .alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (
            first & (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id")))
        ).alias("kept"),
        "text_sha256",
        "n_chunks",
    )
