from __future__ import annotations

from pyspark.sql import functions as F

from changecapture.llm.decontaminate import contaminated, drop_contaminated
from changecapture.llm.jaccard_join import drop_near_duplicates
from changecapture.llm.suffix_dedup import drop_repeated_bytes

#: Two texts of one 32-bit Murmur hash.
ONE = "bhnd anhd kioa ekmf cgmm kgfn eepo aphb kemf engn kgae bglm"
TWO = "jdje bohj dddf addf ebdi cbho njpi iiid efmd cdcj aoml oloc"


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_texts_of_one_hash_are_several_documents(spark):
    docs = frame(spark, [(None, ONE), (None, TWO), (1, ONE)])
    assert docs.select(F.hash("text")).distinct().count() == 1
    assert set(map(tuple, drop_near_duplicates(docs).collect())) == {(1, ONE), (None, TWO)}
    done = drop_repeated_bytes(docs, 20, 8).collect()
    assert sorted(bytes(r.kept).decode() for r in done) == ["", "", TWO]
    bench = spark.createDataFrame([(7, ONE)], "item_id long, text string")
    assert sorted((r.doc_id or 0, r.item_ids) for r in contaminated(docs, bench).collect()) == [(0, []), (0, [7]), (1, [7])]
    assert drop_contaminated(docs, bench).collect() == [(None, TWO)]


def test_clean_rows_that_repeat_stay(spark):
    bench = spark.createDataFrame([(7, ONE)], "item_id long, text string")
    docs = frame(spark, [(None, ONE), (3, TWO), (3, TWO), (None, TWO), (None, TWO)])
    assert drop_contaminated(docs, bench).count() == 4


def test_extra_columns_may_have_any_name(spark):
    rows = [(1, ONE, "a", "b", "c"), (2, ONE, "a", "b", "c"), (3, TWO, "a", "b", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string, _Key_ string, _text string")
    assert drop_near_duplicates(docs).columns == docs.columns
    assert sorted(r.doc_id for r in drop_near_duplicates(docs).collect()) == [1, 3]
    bench = spark.createDataFrame([(7, ONE)], "item_id long, text string")
    assert drop_contaminated(docs, bench).collect() == [(3, TWO, "a", "b", "c")]
