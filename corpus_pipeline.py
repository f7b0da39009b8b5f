"""The corpus pipeline: five stages over documents, each written and read again.

Language ID, exact dedup, near-dedup, secret scans, packing. A stage takes all that the one before
kept; all but the last return the columns of documents. Documents without letters, null and empty
ones among them, go in the first stage; of repeated rows one stays after the second; a row without an
id is never a near copy; columns beside those read are carried; no documents give no sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.llm import common, exact_dedup, langid, near_dedup, packing, secrets
from duebook.llm.queries import tokenizer


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models accept; the others go. `lang` is what was recognised."""
    model = langid.learned(docs.where(~langid.held_out(F.col("doc_id"), 3, 1)))
    judged = langid.identify(docs, model).where("accepted")
    return judged.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.dedup(docs).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_dedup.dedup(docs).select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live credentials masked; n_chars follows the text."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: whole pieces of power-of-two lengths, with their ids."""
    p = packing.pack(docs, tokenizer("byte_bpe_50k.json"))
    return p.select("sequence_id", "doc_id", "start", "length", "offset", "doc_tokens", F.crc32("ids").alias("ids_crc32"), "ids")


STAGES = [
    ("language", known_language),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: SQL has no language models, no ProbMinHash and no tokenizer: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn on the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = common.settle(docs, f"stage-{k + 1}")
    return docs
