"""Corpus pipeline: language ID, exact dedup, near dedup, source mixing, piece encoding.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidings.llm import exact_dedup, language_ppm, mixing, ngram_join, piece_codec
from tidings.llm.common import documents, staged


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language_ppm.stage(spark, docs, sf_dir)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup.keep_distinct(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group linked by shared shingles, the document with the smallest doc_id.

    Near copies share at least 0.8 of their five-word shingles (op6 alone: four words, 0.85).
    """
    return ngram_join.keep_one(docs, words=5, num=80, den=100)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their source's rate, in global random order."""
    return mixing.stage(spark, docs, sf_dir)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document and whether they decode to its text."""
    return piece_codec.stage(spark, docs, sf_dir)


STAGES = [("language ID", language), ("exact dedup", exact), ("near dedup", near), ("mixing", mixed),
          ("piece encoding", encoded)]

#: Language models and piece encoding have no SQL form; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: one row per kept copy, with the columns of the piece codec's query.

    An empty table gives no rows; documents without letters go if any language
    can be learned from the table; of equal texts one stays, null and repeated
    ids included; columns that have names of an operator's own keep their
    values up to the last stage.
    """
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{i}")
    return docs
