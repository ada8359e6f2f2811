"""Token counts through a digest cache.

Counts are stored under (content digest, tokenizer digest).  Documents are
joined to the cache by digest, only distinct missing contents are encoded, and
their counts are appended.  The tokenizer digest covers the model file and the
library version, so a new tokenizer never reads old counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, short_batches, staged

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"


def model_path(model: str) -> str:
    """The place of a tokenizer file: as given, or a public vocabulary by name."""
    import os

    import public_tokenizers
    return model if os.path.isabs(model) else public_tokenizers.path(model)


def processor(model: str):
    """The SentencePiece processor; each task loads its own."""
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=model_path(model))


def tokenizer_digest(model: str) -> str:
    import sentencepiece
    with open(model_path(model), "rb") as f:
        return hashlib.sha256(f.read() + sentencepiece.__version__.encode()).hexdigest()


def content(text: Column) -> Column:
    """Content as the tokenizer sees it: null is empty, nothing else changes a count-free part."""
    return F.coalesce(text, F.lit(""))


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(content(text), 256))


def _count_tokens(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(model)
        met = set()
        for batch in batches:
            digests, chosen = batch.column("digest").to_pylist(), []
            # Rows that repeat a chosen id and text come to the same task; the first of them is encoded.
            for i, digest in enumerate(digests):
                if digest not in met:
                    met.add(digest)
                    chosen.append(i)
            texts, counts = batch.column("text").take(pa.array(chosen, pa.int64())), []
            for at in range(0, len(chosen), 64):
                counts += [len(ids) for ids in sp.encode(texts.slice(at, 64).to_pylist(), num_threads=1)]
            yield pa.RecordBatch.from_arrays([pa.array([digests[i] for i in chosen], pa.binary()), pa.array(counts, pa.int64())], ["digest", "n_tokens"])
    return run


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """All stored counts; an absent cache is an empty one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(cache)


def token_counts(docs: DataFrame, cache: str, model: str = MODEL) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens; appends new counts to ``cache``.

    Null counts as empty (0 tokens).  Null ids and repeated rows each keep
    their row; repeated contents are encoded once.  An empty table gives no
    rows and stores nothing.  Further columns are not read.
    """
    spark = docs.sparkSession
    short_batches(spark)
    version = tokenizer_digest(model)
    rows = staged(docs.select("doc_id", F.octet_length(content(F.col("text"))).cast("long").alias("n_bytes"),
                              content_digest(F.col("text")).alias("digest")), "content_digests")
    known = read_cache(spark, cache).where(F.col("tokenizer") == version).select("digest", "n_tokens")
    missing = (rows.groupBy("digest").agg(F.min("doc_id").alias("first_id")).join(known, "digest", "left_anti")
               .withColumnRenamed("digest", "m_digest"))
    texts = docs.select("doc_id", content(F.col("text")).alias("text"), content_digest(F.col("text")).alias("digest"))
    # One row stands for each missing content, with those that repeat its id and text.
    chosen = texts.join(missing, (F.col("digest") == F.col("m_digest")) & F.col("doc_id").eqNullSafe(F.col("first_id"))).select("digest", "text")
    fresh = chosen.mapInArrow(_count_tokens(model), "digest binary, n_tokens long").dropDuplicates(["digest"])
    fresh.withColumn("tokenizer", F.lit(version)).write.mode("append").parquet(cache)
    # Two runs that missed the same content may both have appended it, with the same count.
    counts = staged(read_cache(spark, cache).where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "token_counts")
    return rows.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """All documents, delivered in two parts: the second meets the counts that the first one stored."""
    cache = new_path(spark, "token_cache")
    early = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    first = token_counts(docs.where(early), cache)
    return first.unionByName(token_counts(docs.where(~early), cache)).withColumn("over_limit", F.col("n_tokens") > LIMIT)
