"""Mixing sources to target weights by Pareto order sampling.

Each source has a target, the number of words that the mix takes from it. A document whose
expected number of copies is ``e`` is taken ``floor(e)`` times for certain, and once more with
the inclusion probability that is left over, ``e - floor(e)``. Documents are ranked by their
random odds divided by their inclusion odds (Pareto order sampling), and those that come first
are taken until the words of the target are reached. What is left of a target after that goes to
the next documents that are short enough for it, so that small sources meet theirs, too.

No source is ever sorted as a whole: the place in the ranking where a target is reached is looked
for in bins of the ranking variable, then in bins of that bin, and rows are sorted within one of
these alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changecapture.llm.common import discard, name128, written

WEIGHTS = (5, 2, 1)
#: No source is taken more often than this, and no document either.
MOST = 3
#: Bins of the ranking variable, and bins in one of them.
BINS = 4096
#: How often the documents that are left are gone through, and the share of a target that may be
#: missing without going through them again.
PASSES, CLOSE = 4, 0.001
#: Equal rows that are dealt out in a step.
COPIES = 4096


def word_count(text: Column) -> Column:
    pattern = F.lit(r"[^\x20\x09-\x0D]+")
    return F.regexp_count(F.coalesce(text, F.lit("")), pattern).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``target`` to sources and their sizes (``source, source_size``).

    The weights repeat over the sources in order of code point, null last. All words are shared
    by weight. A share above ``most`` times the size of its source stops there, and the excess is
    shared by weight among the others, until none is above: in the order of size by weight those
    that stop come first. There is a row for each source, and one task sees them all.
    """
    every = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn(
        "weight", F.get(every, (F.row_number().over(by_name) - 1) % len(weights))
    ).withColumn("cap", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - (F.sum("cap").over(order) - F.col("cap"))
    following = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumn("level", left / F.sum("weight").over(following))
    # the first source that does not stop sets the level for all that follow
    goes_on = F.when(F.col("cap") > F.col("weight") * F.col("level"), F.col("level"))
    rows = rows.withColumn("shared", F.first(goes_on, True).over(everything))
    share = F.coalesce(F.col("weight") * F.col("shared"), F.col("cap"))
    return rows.withColumn("target", F.least("cap", share)).drop("weight", "cap", "level", "shared")


def _uniform(*parts: Column) -> Column:
    """Number between 0 and 1, both excluded: 48 bits of the SHA-256 of the parts."""
    seed = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])
    bits = F.conv(F.substring(F.sha2(seed, 256), 1, 12), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 48)


def _joined(left: DataFrame, right: DataFrame, keys: tuple = (), how: str = "inner") -> DataFrame:
    """Join on the source, which may be null, and on further columns."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in ("source", *keys)})
    same = left["source"].eqNullSafe(right["_right_source"])
    for key in keys:
        same = same & (left[key] == right[f"_right_{key}"])
    return left.join(right, same, how).drop(*[f"_right_{k}" for k in ("source", *keys)])


def _filled(rows: DataFrame, keys: list[str], rooms: DataFrame) -> DataFrame:
    """Bins of rows in their order: whether a bin is inside its room, and the words before it.

    ``rooms`` hold ``source, room, upto`` (words before the first bin). Bins beyond the one in
    which the room ends are left out.
    """
    bins = rows.groupBy("source", *keys).agg(F.sum("size").alias("words"))
    order = Window.partitionBy("source").orderBy(*keys)
    bins = _joined(bins, rooms).withColumn(
        "upto", F.col("upto") + F.sum("words").over(order) - F.col("words")
    )
    bins = bins.where(F.col("upto") <= F.col("room"))
    return bins.withColumn("inside", F.col("upto") + F.col("words") <= F.col("room")).drop("words")


def _pass(rows: DataFrame, rooms: DataFrame) -> DataFrame:
    """``rows`` with ``extra`` set on the first documents of the ranking that fit into the rooms."""
    place = F.col("rank") * BINS
    fits = ~F.col("extra") & F.col("rank").isNotNull() & (F.col("size") <= F.col("room"))
    rows = _joined(rows, rooms, how="left").withColumns(
        {
            "coarse": F.when(fits, F.floor(place)),
            "fine": F.when(fits, F.floor((place - F.floor(place)) * BINS)),
        }
    )
    rooms = rooms.withColumn("upto", F.lit(0).cast("long"))
    waiting = rows.where("coarse is not null").drop("room")
    coarse = written(_filled(waiting, ["coarse"], rooms))
    at_edge = coarse.where("not inside")
    edge = _joined(waiting, at_edge.select("source", "coarse"), ("coarse",))
    fine = _filled(edge, ["coarse", "fine"], at_edge.select("source", "room", "upto"))
    last = _joined(edge, fine.where("not inside").drop("inside"), ("coarse", "fine"))
    order = Window.partitionBy("source").orderBy("rank", "row")
    reached = F.col("upto") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    last = last.withColumn("reached", reached).where("reached <= room")
    last = last.select("source", "row", "coarse")

    flag = lambda df, keys, name: df.select("source", *keys, F.lit(True).alias(name))
    marks = (
        (flag(coarse.where("inside"), ["coarse"], "one"), ("coarse",)),
        (flag(fine.where("inside"), ["coarse", "fine"], "two"), ("coarse", "fine")),
        (flag(last, ["coarse", "row"], "three"), ("coarse", "row")),
    )
    done = reduce(lambda df, mark: _joined(df, *mark, how="left"), marks, rows)
    extra = F.col("extra") | F.coalesce("one", "two", "three", F.lit(False))
    out = written(done.withColumn("extra", extra).select(*rows.columns).drop("coarse", "fine", "room"))
    discard(coarse)
    return out


def _rooms(rows: DataFrame, sources: DataFrame, close: float = 0.0) -> DataFrame:
    """Words that are missing to the targets of sources, where that is more than a share of them."""
    taken = F.col("size") * (F.col("whole") + F.col("extra").cast("int"))
    have = rows.groupBy("source").agg(F.sum(taken).alias("have"))
    room = F.col("target") - F.col("have")
    rooms = _joined(sources, have).withColumn("room", room)
    return written(rooms.where(F.col("room") > F.col("target") * close).select("source", "room"))


def allocate(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weight_column: str | None = None,
    weights: tuple = WEIGHTS,
    most: int = MOST,
    passes: int = PASSES,
) -> DataFrame:
    """How often the mix takes each row of ``docs``.

    Returns ``doc_id, text_name`` (hex of 128 bits of the text's SHA-256)``, source, size,
    source_size, target, copies, taken``; ``size`` counts words and ``taken = size * copies``.
    Within a source the expected copies of a document are in proportion to ``weight_column``
    (null counts as 0), or equal; ``most`` copies are the limit. The taken words of a source miss its
    target by no more than half of the shortest document that could still be taken.

    The draw follows from id and text alone, so that a rerun repeats it. Null texts are empty and
    have size 0. A null source is a source. Rows that repeat id, text and source are numbered and
    drawn one by one. Other columns are ignored, and an empty table gives an empty table.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    weight = F.coalesce(F.col(weight_column), F.lit(0)) if weight_column else F.lit(1)
    equal = docs.select(
        F.col(id_column).alias("doc_id"),
        F.lower(F.hex(name128(text))).alias("text_name"),
        F.col(source_column).alias("source"),
        word_count(text).alias("size"),
        weight.cast("double").alias("weight"),
    )
    equal = equal.groupBy(*equal.columns).agg(F.count("*").alias("n"))
    # in two steps, so that no array grows with the number of equal rows
    blocks = F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES))
    in_block = F.least(F.lit(COPIES), F.col("n") - F.col("block") * COPIES)
    rows = written(
        equal.withColumn("block", F.explode(blocks))
        .withColumn("in_block", F.explode(F.sequence(F.lit(1), in_block.cast("int"))))
        .withColumn("copy", F.col("block") * COPIES + F.col("in_block"))
        .drop("n", "block", "in_block")
    )

    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.sum(F.col("size") * F.col("weight")).alias("weighted"),
    )
    sources = written(targets(sizes, weights, most))
    rho = F.try_divide(F.col("target"), F.col("weighted")) * F.col("weight")
    expected = F.least(F.lit(float(most)), F.coalesce(rho, F.lit(0.0)))
    odds = F.col("chance") / (1 - F.col("chance"))
    drawn = F.col("draw") / (1 - F.col("draw")) / odds
    ranked = (
        _joined(rows, sources)
        .withColumn("expected", expected)
        .withColumn("whole", F.floor("expected"))
        .withColumn("chance", F.col("expected") - F.col("whole"))
        .withColumn("draw", _uniform(F.col("doc_id"), F.col("text_name"), F.col("copy")))
        .withColumn("rank", F.when(F.col("chance") > 0, drawn / (1 + drawn)))
        .select(
            "doc_id", "text_name", "copy", "source", "size", "whole", "rank",
            F.concat_ws("|", "doc_id", "text_name", "weight", "copy").alias("row"),
            F.lit(False).alias("extra"),
        )
    )
    state = written(ranked)
    for _ in range(passes):
        rooms = _rooms(state, sources, CLOSE)
        if rooms.isEmpty():
            break
        before, state = state, _pass(state, rooms)
        discard(before, rooms)
    # one more document where that comes nearer than none
    nearest = (
        _joined(state.where("not extra and rank is not null and size > 0"), _rooms(state, sources))
        .where(F.col("size") < 2 * F.col("room"))
        .groupBy("source")
        .agg(F.min(F.struct("size", "rank", "row")).alias("one"))
        .select("source", F.col("one.row").alias("row"), F.lit(True).alias("one"))
    )
    copies = F.col("whole") + (F.col("extra") | F.coalesce("one", F.lit(False))).cast("int")
    return (
        _joined(_joined(state, written(nearest), ("row",), "left"), sources)
        .withColumn("copies", copies)
        .select(
            "doc_id", "text_name", "source", "size", "source_size", "target", "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
        )
    )


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    **settings,
) -> DataFrame:
    """The mixed table itself: rows of ``docs``, each as often as it is taken.

    Of rows that repeat id, text and source any one stands for all of them.
    """
    taken = allocate(docs, id_column, text_column, source_column, **settings)
    keys = {"_mix_id": "doc_id", "_mix_text": "text_name", "_mix_source": "source"}
    totals = taken.groupBy(*keys.values()).agg(F.sum("copies").alias("_mix_copies"))
    totals = totals.where("_mix_copies > 0").select(
        F.struct(*[F.col(c).alias(k) for k, c in keys.items()]).alias("_mix_key"), "_mix_copies"
    )
    text = F.lower(F.hex(name128(F.coalesce(F.col(text_column), F.lit("")))))
    key = F.struct(
        F.col(id_column).alias("_mix_id"),
        text.alias("_mix_text"),
        F.col(source_column).alias("_mix_source"),
    )
    rows = docs.withColumn("_mix_key", key).dropDuplicates(["_mix_key"]).join(totals, "_mix_key")
    blocks = F.sequence(F.lit(0), F.floor((F.col("_mix_copies") - 1) / COPIES))
    in_block = F.least(F.lit(COPIES), F.col("_mix_copies") - F.col("_mix_block") * COPIES)
    return (
        rows.withColumn("_mix_block", F.explode(blocks))
        .withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), in_block.cast("int"))))
        .select(*docs.columns)
    )
