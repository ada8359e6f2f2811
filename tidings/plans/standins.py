"""Stand-in inputs built from the driver's test tables.

The test tables carry no Chinese news, parses or cluster state, so each
registered query first shapes the tables into the schema its operator
expects.  These builders only rename, cast and tokenise; the operators do
the work.  Each builder has a twin SQL fragment (``*_SQL``) used by the
independent DuckDB oracle.

* articles   ← documents: id=doc_id, title = first line, content = text,
  dataSource = source, publishAt = 2024-01-01T00:00Z + doc_id minutes, pos = doc_id.
* tokens     ← ``[A-Za-z]+`` runs, lower-cased; nature = ``nz`` when the run
  starts upper-case, ``v`` when it ends in ``ing``/``ed``, else ``n``.
* stream     ← events: id=event_id, publishAt = ts (UTC) in ms.
* vectors    ← embeddings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import bag_of_words
from ..session import ntz_to_ms

BASE_MS = 1704067200000  # 2024-01-01T00:00:00Z

# Latin stand-in lexicons (own lists; fixed so the oracle can repeat them).
STOP_WORDS = (
    "the", "and", "of", "to", "a", "in", "is", "it", "on", "as", "by", "for", "with", "that", "this",
    "de", "la", "le", "et", "les", "des", "du", "un", "une", "en", "au", "pour",
    "der", "die", "und", "das", "den", "el", "los", "que", "y", "por",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one test table (split size is a session setting)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("id"),
        F.substring_index(F.col("text"), "\n", 1).alias("title"),
        F.col("text").alias("content"),
        F.col("source").alias("dataSource"),
        (F.lit(BASE_MS) + F.col("doc_id") * 60000).alias("publishAt"),
        F.col("doc_id").alias("pos"),
    )


ARTICLES_SQL = """articles AS (
  SELECT doc_id AS id, split_part(text, chr(10), 1) AS title, text AS content,
         source AS dataSource, 1704067200000 + doc_id * 60000 AS publishAt, doc_id AS pos
  FROM documents)"""


def raw_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, term, tf, first_idx) of the lower-cased letter runs of every content.  The texts are exchanged by id, not
    their terms: what is counted or ranked per document afterwards needs no exchange of its own."""
    a = articles(spark, sf_dir).select("id", "content").repartition("id")
    return bag_of_words(a.select("id", F.transform(F.regexp_extract_all(
        F.coalesce("content", F.lit("")), F.lit("[A-Za-z]+"), 0), F.lower).alias("l")), "id", "l")


SEG_TYPE = "array<struct<word:string,nature:string>>"


def empty_seg() -> Column:
    return F.array().cast(SEG_TYPE)


def seg(text: Column) -> Column:
    """Stand-in segmentation: array<struct<word, nature, offset>> of letter runs.

    ``offset`` is the running length of the previous words, as the segmenter
    reports it.
    """
    runs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[A-Za-z]+"), 0)
    return F.transform(runs, lambda x: F.struct(F.lower(x).alias("word"), nature(x).alias("nature")))


def upper_first(run: Column) -> Column:
    """Whether a letter run starts upper-case: such runs, and no others, sort before ``[`` (plain comparison, no pattern)."""
    return run < F.lit("[")


def nature(run: Column) -> Column:
    """POS stand-in of a letter run."""
    low = F.lower(run)
    return (F.when(upper_first(run), F.lit("nz"))
             .when(low.endswith("ing") | low.endswith("ed"), F.lit("v"))
             .otherwise(F.lit("n")))


def seg_sql(expr: str) -> str:
    """DuckDB list of {word, nature} for the same stand-in segmentation."""
    return (f"list_transform(regexp_extract_all(coalesce({expr}, ''), '[A-Za-z]+'), lambda x: "
            "{'word': lower(x), 'nature': CASE WHEN regexp_matches(x, '^[A-Z]') THEN 'nz' "
            "WHEN regexp_matches(lower(x), '(ing|ed)$') THEN 'v' ELSE 'n' END})")


def stop_sql() -> str:
    return "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("id"), F.col("ts"), ntz_to_ms(F.col("ts")).alias("publishAt"),
        "user_id", "event_type", "value",
    )


STREAM_SQL = """stream AS (
  SELECT event_id AS id, ts, epoch_us(ts) // 1000 AS publishAt, user_id, event_type, value FROM events)"""
