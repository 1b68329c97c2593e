"""The corpus pipeline: quality rules, near-duplicates, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Every stage takes all
rows and whole texts, however long; other columns of ``docs``, whatever their names, are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm.minhash import near_duplicates
from matchloom.llm.packing import pieces
from matchloom.llm.pii import redact_documents
from matchloom.llm.quality import quality
from matchloom.llm.shared import materialize, scratch
from matchloom.llm.suffixes import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the limits, or are outliers of their language and source, go. Null and empty texts fail; null languages and sources
    form groups of their own; repeated rows are judged alike."""
    return quality(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least doc_id stays. Null and empty texts and null doc_ids stay. Rows that repeat a
    doc_id stay or go together: all go if one of them does."""
    gone = near_duplicates(docs.select("doc_id", "text")).where("NOT kept").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages that a document with a smaller doc_id has go. Of a character that is cut the rest goes too, so that the text stays
    UTF-8. Every document stays, if with an empty text; null texts become empty; null doc_ids lose nothing; repeated rows lose alike."""
    out = remove_repeats(docs.select(*COLUMNS), with_text=True).withColumnRenamed("kept_text", "text")
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in brackets. Null texts stay null; every row stays."""
    return redact_documents(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 ids; null and empty texts are the end id alone; repeated rows are packed as often as they come."""
    return pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Outlier estimates, repeated passages, boosted trees and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written to the shared folder and read again, and what it wrote in between is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch():
            docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}", outlive=True)
    return STAGES[-1][1](spark, docs, sf_dir)
