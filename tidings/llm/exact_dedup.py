"""Exact dedup with a persistent digest index (DataFrame and SQL functions only).

The index is a table bucketed and sorted by digest.  A batch of new rows is
reduced to one row per digest, deduplicated against the index by a sort-merge
anti join (the index side is neither shuffled nor sorted again) and appended.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged


def normal_text(text: Column) -> Column:
    """Null counts as empty; A-Z only are lower-cased."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(normal_text(text), 256))


class DigestIndex:
    """Table ``digest, keep_id`` bucketed and sorted by digest.

    ``keep_id`` is the largest doc_id of the batch that brought the digest, so
    earlier batches win over later ones.  ``buckets`` defaults to the session's
    shuffle partitions and stays fixed for the life of the table.
    """

    def __init__(self, spark: SparkSession, table: str, buckets: int | None = None):
        self.spark, self.table = spark, table
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def ingest(self, rows: DataFrame) -> None:
        """Append the digests of ``rows`` (doc_id, digest) that the index does not hold."""
        fresh = rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        if self.exists():
            fresh = fresh.repartition(self.buckets, "digest").join(self.read().hint("merge"), "digest", "left_anti")
        (fresh.repartition(self.buckets, "digest").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table))


def exact_dedup(docs: DataFrame, table: str | None = None, buckets: int | None = None, batches: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest, keep_id, group_size, kept.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty.  Of equal texts the largest doc_id stays: the documents are ingested
    in batches of falling doc_id, so the first one to bring a digest wins.
    Null ids come last (a group of null ids alone has keep_id null and is
    kept).  Rows that repeat doc_id and text are one document: they get the
    same row each, and count in group_size.  An empty table gives no rows;
    further columns are not read.

    ``table`` names an index that outlives the call; digests it already holds
    keep the id stored there.
    """
    spark = docs.sparkSession
    index = DigestIndex(spark, table or f"digest_index_{uuid.uuid4().hex}", buckets)
    rows = staged(docs.select("doc_id", text_digest(F.col("text")).alias("digest")), "digests")
    cuts = sorted(set(rows.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01)), reverse=True)
    high = None
    for cut in [*cuts, None]:
        part = rows
        if high is not None:
            part = part.where(F.col("doc_id").isNull() | (F.col("doc_id") < high))
        if cut is not None:
            part = part.where(F.col("doc_id") >= cut)
        index.ingest(part)
        high = cut
    sizes = rows.groupBy("digest").agg(F.count("*").alias("group_size"))
    # Written before the join, so that both join sides are plain exchanges,
    # which Spark splits when one digest holds a large share of the rows.
    stats = staged(sizes.join(index.read(), "digest"), "digest_stats")
    return rows.join(stats, "digest").select(
        "doc_id", "digest", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"))


def keep_distinct(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per digest, with all its columns: that of the largest doc_id (null when all are null).

    Of rows that repeat the id as well, the one with the smallest hash of all columns stays.
    """
    kept = staged(exact_dedup(docs).where("kept").groupBy(F.col("digest").alias("__digest")).agg(F.first("doc_id").alias("__id"), F.count("*").alias("__copies")), "kept_digests")

    def rows(part: DataFrame) -> DataFrame:
        # doc_id alone decides unless ids repeat, so the digest is compared too.
        return docs.join(part, F.col("doc_id").eqNullSafe(F.col("__id")) & (text_digest(F.col("text")) == F.col("__digest")), "left_semi")

    once = rows(kept.where("__copies = 1"))
    # Written on its own: mostly empty or small, so that the texts need not move for it.
    several = rows(staged(kept.where("__copies > 1"), "repeated_digests"))
    whole = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])))
    first = F.row_number().over(Window.partitionBy(text_digest(F.col("text"))).orderBy(whole))
    return once.union(several.withColumn("__row", first).where("__row = 1").drop("__row"))


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return exact_dedup(docs).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


SQL = """
WITH n AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY text_sha256)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, n.text_sha256
FROM n JOIN g USING (text_sha256)
"""
