"""Repeated runs of lines by prefix doubling over line names (DataFrame functions only).

The corpus is a set of sequences of line names. Lines whose name is unique drop out, as
nothing longer can repeat there. The positions that are left are named by the 1, 2, 4, ...
lines that start there: a round pairs the names at offset 0 and 2^j. Names are 128-bit
digests instead of sort ranks, so they are compared by hash, without a global sort.

A run is deleted where it repeats an earlier run (order: document id, line) and holds at
least ``min_words`` words. A line has one word at least, so every such run is a union of
windows of at most ``min_words`` lines: for each line the shortest one that starts there and
the shortest one that ends there. Each is named by two overlapping power-of-two names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changecapture.llm.common import discard, name128, written

MIN_WORDS = 10


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key(id_column: str, text_column: str) -> list[Column]:
    """Identity of a document: its id (in a struct, so that nulls match) and its text."""
    return [
        F.struct(F.col(id_column).alias("id")).alias("_id"),
        F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("_text"),
    ]


def line_table(docs: DataFrame, min_words: int, id_column: str, text_column: str) -> DataFrame:
    """Lines with words, numbered without the blank ones, and their two shortest windows."""
    numbered = F.filter(
        F.transform(
            _lines(F.col(text_column)),
            lambda line, i: F.struct(i.alias("line"), F.trim(line).alias("content")),
        ),
        lambda x: x["content"] != "",
    )
    lines = docs.select(
        *_key(id_column, text_column), F.posexplode(numbered).alias("at", "x")
    ).select(
        "_id",
        "_text",
        "at",
        F.col("x.line").alias("line"),
        F.size(F.split(F.col("x.content"), r"\s+")).cast("long").alias("words"),
        name128(F.col("x.content")).alias("name"),
    )
    doc = Window.partitionBy("_id", "_text")
    upto = F.sum("words").over(doc.orderBy("at"))
    ahead = doc.orderBy("before").rangeBetween(0, min_words - 1)
    behind = doc.orderBy("upto").rangeBetween(-(min_words - 1), 0)
    # on identical rows of documents a position repeats: count it once
    return (
        lines.dropDuplicates(["_id", "_text", "at"])
        .withColumn("upto", upto)
        .withColumn("before", F.col("upto") - F.col("words"))
        .withColumn("ahead", F.when(F.sum("words").over(ahead) >= min_words, F.count("at").over(ahead)))
        .withColumn(
            "behind", F.when(F.sum("words").over(behind) >= min_words, F.count("at").over(behind))
        )
        .drop("upto", "before")
    )


def _named(ranked: DataFrame, min_words: int) -> DataFrame:
    """Both windows of each line by name: ``_id, _text, at, length, name``.

    Prefix doubling: the name of twice as many lines is the pair of the names here and that
    many lines on. A name is null where a line in between has dropped out.
    """
    doc = Window.partitionBy("_id", "_text").orderBy("at")
    spans = [1]
    while 2 * spans[-1] <= min_words:
        spans.append(2 * spans[-1])
    named = ranked.withColumn("of1", F.col("name"))
    for span in spans[:-1]:
        near = F.lead("at", span).over(doc) == F.col("at") + span
        pair = F.concat(f"of{span}", F.lead(f"of{span}", span).over(doc))
        named = named.withColumn(f"of{2 * span}", F.when(near, name128(pair)))

    def name(length: int, back: int) -> Column:
        """Name of the window of ``length`` lines that starts ``back`` lines before this one."""
        span = max(s for s in spans if s <= length)
        head, tail = f"of{span}", f"of{span}"
        first = F.lag(head, back).over(doc) if back else F.col(head)
        offset = length - span - back
        last = (
            F.lead(tail, offset).over(doc)
            if offset > 0
            else F.lag(tail, -offset).over(doc)
            if offset
            else F.col(tail)
        )
        # the lines between must be those of the window
        start = F.lag("at", back).over(doc) == F.col("at") - back if back else F.lit(True)
        stop = F.lead("at", length - 1 - back).over(doc) == F.col("at") + length - 1 - back if length - 1 > back else F.lit(True)
        return F.when(start & stop, F.concat(first, last))

    lengths = range(1, min_words + 1)
    ahead = F.coalesce(*[F.when(F.col("ahead") == n, name(n, 0)) for n in lengths])
    behind = F.coalesce(*[F.when(F.col("behind") == n, name(n, n - 1)) for n in lengths])
    both = named.select(
        "_id",
        "_text",
        F.array(
            F.struct(F.col("at"), F.col("ahead").alias("length"), ahead.alias("name")),
            F.struct(
                (F.col("at") - F.col("behind") + 1).cast("int").alias("at"),
                F.col("behind").alias("length"),
                behind.alias("name"),
            ),
        ).alias("windows"),
    )
    return (
        both.select("_id", "_text", F.inline("windows"))
        .where("name IS NOT NULL")
        .withColumn("name", name128(F.concat("name", F.col("length").cast("string").cast("binary"))))
        .distinct()
    )


def repeated_runs(
    docs: DataFrame, min_words: int = MIN_WORDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Lines to delete: ``_id, _text, lines`` (sorted numbers of lines, from 0)."""
    if min_words < 1:
        raise ValueError("min_words must be at least 1")
    lines = written(line_table(docs, min_words, id_column, text_column))
    # aggregates are tables of their own, so that a very frequent name can be split in the join
    often = written(lines.groupBy("name").count().where("count > 1").select("name"))
    found = written(_named(lines.join(often, "name", "left_semi"), min_words))
    discard(often)
    first = written(
        found.groupBy("name")
        .agg(F.min(F.struct("_id", "_text", "at")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    later = found.join(first, "name").where(
        ~F.struct("_id", "_text", "at").eqNullSafe(F.col("first"))
    )
    gone = later.select(
        "_id",
        "_text",
        F.explode(F.sequence(F.col("at"), (F.col("at") + F.col("length") - 1).cast("int"))).alias("at"),
    ).distinct()
    return (
        lines.select("_id", "_text", "at", "line")
        .join(gone, ["_id", "_text", "at"])
        .groupBy("_id", "_text")
        .agg(F.sort_array(F.collect_set("line")).alias("lines"))
    )


def drop_repeated_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Documents with later copies of repeated runs of lines deleted from ``text``.

    Lines end at a newline and are compared without outer blanks; lines without words are
    no part of a run and stay. All columns are kept, in their order, and ``removed_lines``
    (numbers from 0, empty where nothing is deleted) is added, replacing a column of that
    name. Null texts stay null. Null ids are ids. The first copy is judged on the input:
    where a run overlaps its own repetition, the overlapping later part goes. Rows with the
    same id and text are one document and get the same result each. An empty table gives
    an empty table.
    """
    runs = repeated_runs(docs, min_words, id_column, text_column)
    own = [c for c in docs.columns if c != "removed_lines"]
    left = docs.select(
        F.struct(F.lit(1).alias("_"), *[docs[c] for c in own if c != text_column]).alias("_row"),
        F.split(F.col(text_column), "\n", -1).alias("_lines"),
        *_key(id_column, text_column),
    )
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("lines"))
    rest = F.when(F.col("lines").isNull(), F.col("_lines")).otherwise(
        F.transform(kept, lambda i: F.get(F.col("_lines"), i))
    )
    joined = left.join(runs, ["_id", "_text"], "left")
    return joined.select(
        *[
            (F.array_join(rest, "\n") if c == text_column else F.col("_row")[c]).alias(c)
            for c in own
        ],
        F.coalesce("lines", F.array().cast("array<int>")).alias("removed_lines"),
    )
