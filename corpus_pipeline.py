"""Training-data pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Every stage works on all that its predecessor kept:

1. language ID: the predicted language becomes ``lang``; documents without a language go (``LANGUAGES`` may ask for some only);
2. exact dedup: the longest original of equal normalised texts stays;
3. MinHash near-dedup: five-word shingles, similarity 0.8; the least doc_id of a group stays;
4. benchmark decontamination: documents that hold an item within its word edits go;
5. packing: the rest as sequences of 2048 tokens, one row a piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagemill.llm import decontaminate, exact_dedup, langid, near_dedup, packing
from pagemill.llm.common import materialize, release, table, written

#: The languages that stay; None: every one that the labels teach.
LANGUAGES: tuple[str, ...] | None = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, LANGUAGES)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs)


def near_deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs, width=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", deduplicate),
    ("near_dedup", near_deduplicate),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: No stage but the second can be told in SQL; tests/llm holds the whole against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, first = table(spark, sf_dir, "documents"), written()
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark, first, -1)  # what the stage wrote on its way, and its input
    return docs
