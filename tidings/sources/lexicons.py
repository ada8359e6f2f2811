"""Lexicon, stop-word and synonym loaders over line tables.

A line table is (file, line_no, value): one row per text line, as
``spark.read.text`` plus a line number gives.  Every loader works per
file, so many lexicons load in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import py_strip


def read_lines(spark: SparkSession, path: str, file_id: str | None = None) -> DataFrame:
    """(file, line_no, value) of a text file; line order is kept by
    ``monotonically_increasing_id`` (which follows file order within a split)."""
    df = spark.read.text(path)
    return df.select(F.lit(file_id or path).alias("file"),
                     F.monotonically_increasing_id().alias("line_no"), "value")


def _until_blank(lines: DataFrame) -> DataFrame:
    """Keep the lines of each file before its first blank line."""
    first_blank = (lines.where(F.length(py_strip(F.col("value"))) == 0)
                        .groupBy("file").agg(F.min("line_no").alias("_cut")))
    return (lines.join(first_blank, "file", "left")
                 .where(F.col("_cut").isNull() | (F.col("line_no") < F.col("_cut"))).drop("_cut"))


def lexicon(lines: DataFrame, stop_at_blank: bool = True, first_token: bool = False,
            strip_bom: bool = False) -> DataFrame:
    """(file, line_no, entry): stripped lines, cut at the first blank
    line (S9) or all non-blank lines (S10); optionally only the text before
    the first space."""
    df = _until_blank(lines) if stop_at_blank else lines.where(F.length(py_strip(F.col("value"))) > 0)
    v = py_strip(F.col("value"))
    if strip_bom:
        v = F.regexp_replace(v, "^\\uFEFF", "")
    if first_token:
        v = F.split(v, " ").getItem(0)
    return df.select("file", "line_no", v.alias("entry"))


def synonym_pairs(lines: DataFrame) -> DataFrame:
    """(file, word, syn) from ``code=w1 w2 …`` lines, cut at the first
    blank line.  A word maps to the union of the groups it appears in (pairs
    include the word itself); groups are not closed transitively."""
    kept = _until_blank(lines).where(F.col("value").contains("="))
    groups = kept.select("file", "line_no",
                         F.split(py_strip(F.split(py_strip(F.col("value")), "=").getItem(1)), " ").alias("ws"))
    members = groups.select("file", "line_no", F.explode(F.array_distinct("ws")).alias("word"))
    return (members.join(members.withColumnRenamed("word", "syn"), ["file", "line_no"])
                   .select("file", "word", "syn").distinct())
