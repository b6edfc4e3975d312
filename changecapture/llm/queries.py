"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changecapture.llm import language_id, lm_score, sentencepiece_scan, token_alignment, toxicity
from changecapture.llm.collocations import collocations
from changecapture.llm.common import discard, table, written
from changecapture.llm.decontaminate import contaminated
from changecapture.llm.exact_dedup import exact_groups
from changecapture.llm.html_text import extract
from changecapture.llm.jaccard_join import near_duplicates
from changecapture.llm.line_dedup import drop_repeated_lines
from changecapture.llm.mixture import allocate
from changecapture.llm.suffix_dedup import drop_repeated_bytes


#: Public vocabularies; only the driver reads the files.
SENTENCEPIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"


def _remainder(n: int):
    """Fold of a document: a checksum of its id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(_remainder(5) != 0))
    return language_id.identify(docs, model, keep=["doc_id"]).select(
        "doc_id", (_remainder(5) == 0).alias("held_out"), "lang_pred", "score", "accepted"
    )


def op2_sentencepiece(
    spark: SparkSession, sf_dir: str, model_file: str = SENTENCEPIECE_MODEL
) -> DataFrame:
    vocabulary = sentencepiece_scan.load(model_file)
    encoded = sentencepiece_scan.encode(table(spark, sf_dir, "documents"), vocabulary)
    digests = encoded.select(
        "doc_id",
        "text_hash",
        F.size("ids").alias("n_ids"),
        F.xxhash64("ids").alias("ids_hash"),
        "ids",
    )
    # a table in between: a worker holds the caches of the encoder or of the decoder, not of both
    back = sentencepiece_scan.decode(written(digests, "4m"), vocabulary)
    return written(
        back.select(
            "doc_id",
            "n_ids",
            "ids_hash",
            (F.xxhash64("text") == F.col("text_hash")).alias("round_trip"),
        ),
        "4m",
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = drop_repeated_bytes(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id",
        F.size("removed_lines").alias("n_removed"),
        F.concat_ws(",", F.transform("removed_lines", lambda x: x.cast("string"))).alias(
            "removed_lines"
        ),
        F.sha2("text", 256).alias("text_sha256"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(_remainder(3) != 1)
    done = toxicity.score(docs, toxicity.fit(docs, labels), keep=["doc_id"])
    return done.select(
        "doc_id",
        (_remainder(3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "exact",
        "misspelled",
        "quoted",
    )


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), each_row=True).drop("n_chunks")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("first", "text_hash")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = allocate(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "size", "source_size", "target", "taken")


def op13_token_alignment(
    spark: SparkSession, sf_dir: str, byte_bpe: str = BYTE_BPE, pieces: str = SENTENCEPIECE_MODEL
) -> DataFrame:
    aligned = token_alignment.align(
        table(spark, sf_dir, "documents"),
        token_alignment.load_byte_bpe(byte_bpe),
        token_alignment.load_pieces(pieces),
    )
    aligned = written(aligned, token_alignment.TEXT_BATCH)
    scores = token_alignment.link_scores(aligned)
    # the links of all documents are in a table of their own by now
    discard(aligned)
    return scores


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_sentencepiece,
        op3_suffix_dedup,
        op4_html_extraction,
        op5_line_dedup,
        op6_toxicity,
        op7_lm_score,
        op8_exact_dedup,
        op9_jaccard_join,
        op10_decontamination,
        op11_collocations,
        op12_source_mixture,
        op13_token_alignment,
    )
}
