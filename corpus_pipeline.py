"""A text corpus from raw documents to token ids, in stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps, with the
columns of documents; the last returns the ids of the kept texts, as digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelspark.llm.base import stored
from panelspark.llm.decontamination import decontaminate
from panelspark.llm.exact_dedup import deduplicate
from panelspark.llm.language import drop_unknown
from panelspark.llm.near_dedup import drop_near_duplicates
from panelspark.llm.queries import piece_digests, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that are predicted to be in a language of the corpus.

    Null texts, texts without a letter, and texts that every language rejects go; repeated
    rows have one fate, an empty table gives none, other columns are not looked at.
    """
    return drop_unknown(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the largest id of equal texts; null counts as empty, ties keep one row."""
    return deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of near copies.

    Null texts, texts without words and rows without an id stay.
    """
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that repeat a passage of the benchmark; null texts have none."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the remaining texts, and the texts decoded from them, as digests.

    Null is encoded as an empty text; every row gives one.
    """
    return piece_digests(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encode", encode),
]

#: A kernel machine and a tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
