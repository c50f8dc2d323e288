"""The corpus pipeline: language ID, line dedup, SimHash near-dedup, decontamination, tokens.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each stage's rows as Parquet in the shared folder and reads them back as
the next one's documents. All stages but the last return the columns of
``documents``; the last returns a row of token digests per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import bpe, decontam, langid, linedup, simhash
from daybook.llm.common import new_path, table
from daybook.llm.queries import tokenizer_files


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a language that most words agree on, go."""
    return langid.accepted(docs, langid.fit(docs), min_score=0.4)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line (Jaccard of words 0.8 or more) are cut out; every document stays."""
    return linedup.without_repeats(docs, num=4, den=5)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (shingles of five words) stays: the first."""
    return simhash.without_copies(docs, width=5, min_similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of ten words of a benchmark item go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document's text and their round trip."""
    return bpe.round_trip_digests(docs, *tokenizer_files())


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", tokens),
]

#: A conditional random field and 64-bit hashes have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
