"""A corpus pipeline of five stages over the documents table.

Every stage takes what its predecessor kept, is written as Parquet and reread by the next.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changecapture.llm import language_id, sentencepiece_scan
from changecapture.llm.common import table, written
from changecapture.llm.decontaminate import drop_contaminated
from changecapture.llm.jaccard_join import drop_near_duplicates
from changecapture.llm.line_dedup import drop_repeated_lines
from changecapture.llm.queries import SENTENCEPIECE_MODEL


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined stay; models are fitted on the labels given.

    Without any label there is nothing to determine, and documents with letters stay.
    """
    if docs.where("lang IS NOT NULL AND text IS NOT NULL").isEmpty():
        return docs.where(F.col("text").rlike(r"\p{L}"))
    done = language_id.identify(docs, language_id.fit(docs))
    return done.where("accepted").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go; a document left without words goes too."""
    done = drop_repeated_lines(docs)
    shorter = F.size("removed_lines") > 0
    done = done.where(~(shorter & (F.trim("text") == "")))
    n_chars = F.when(shorter, F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.withColumn("n_chars", n_chars.otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the least id."""
    return drop_near_duplicates(docs).select(*docs.columns)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of what is left: ``doc_id, ids``."""
    vocabulary = sentencepiece_scan.load(SENTENCEPIECE_MODEL)
    return sentencepiece_scan.encode(docs, vocabulary).select("doc_id", "ids")


STAGES = [
    ("language ID", languages),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmarks),
    ("SentencePiece", pieces),
]

#: Learned models and tokenizers cannot be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
