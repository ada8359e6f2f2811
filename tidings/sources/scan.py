"""Article scans, id deltas, snapshots, retention and batch windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import DAY_MS

ARTICLE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("dataSource", T.StringType()),
    T.StructField("publishAt", T.LongType()),
    T.StructField("seg_title", T.ArrayType(T.StructType([
        T.StructField("word", T.StringType()), T.StructField("nature", T.StringType()),
        T.StructField("offset", T.IntegerType()), T.StructField("ner", T.StringType())]))),
    T.StructField("seg_content", T.ArrayType(T.StructType([
        T.StructField("word", T.StringType()), T.StructField("nature", T.StringType()),
        T.StructField("offset", T.IntegerType()), T.StructField("ner", T.StringType())]))),
])


def read_articles(spark: SparkSession, path: str, strict: bool = False, need_source: bool = False) -> DataFrame:
    """JSONL article scan with an explicit schema.

    ``strict`` fails on a malformed line (v2 reader); otherwise malformed
    lines are dropped (v1 / state / delta readers).  Rows without title or
    content (and, with ``need_source``, dataSource) are dropped.
    """
    df = spark.read.schema(ARTICLE_SCHEMA).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)
    cond = F.col("title").isNotNull() & F.col("content").isNotNull()
    if need_source:
        cond = cond & F.col("dataSource").isNotNull()
    return df.where(cond)


def ms_to_ntz_literal(ms: int) -> Column:
    """TIMESTAMP_NTZ literal of epoch ms (UTC wall clock); constant-folded so
    comparisons against the raw column push down to the parquet scan."""
    s = (dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=ms)).strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(s).cast("timestamp_ntz")


def window_scan(df: DataFrame, start_ms: int, end_ms: int, ts_col: str = "ts") -> DataFrame:
    """Rows with start ≤ ts ≤ end (both bounds inclusive), filter on the
    stored timestamp column so it reaches the scan as a pushed filter."""
    c = F.col(ts_col)
    return df.where((c >= ms_to_ntz_literal(start_ms)) & (c <= ms_to_ntz_literal(end_ms)))


def window_scan_ms(df: DataFrame, start_ms: int, end_ms: int, ms_col: str = "publishAt") -> DataFrame:
    """S2 over an epoch-ms column."""
    return df.where(F.col(ms_col).between(start_ms, end_ms))


def delta(window: DataFrame, snapshot: DataFrame | None, key: str = "id") -> DataFrame:
    """S3: window rows whose key is not in the previous snapshot (anti join).
    First run (no snapshot) → the whole window."""
    if snapshot is None:
        return window
    return window.join(snapshot.select(key), key, "left_anti")


def gated_snapshot(window: DataFrame, previous: DataFrame, new_rows: DataFrame, min_batch: int = 100) -> DataFrame:
    """S4 + P5: the next snapshot is the whole current window when the batch
    of new rows passes the gate (≥ ``min_batch``), else the previous one.

    The gate is a scalar subquery (one count job), not a cross join.
    """
    n = new_rows.select(F.count(F.lit(1))).scalar()
    gate = n >= F.lit(min_batch)
    return window.where(gate).unionByName(previous.where(~gate))


def write_snapshot(window: DataFrame, root: str, version: int) -> str:
    """S4 sink: write the snapshot as a new version directory; readers take the
    highest committed version, so the path being read is never overwritten."""
    path = f"{root}/v={version:012d}"
    window.write.mode("overwrite").parquet(path)
    return path


def retain(clusters: DataFrame, end_ms: int, n1_days: float, n_days: float,
           size_col: str = "size", time_col: str = "publish_time") -> DataFrame:
    """Drop size-1 clusters older than ``n1_days`` and larger ones older
    than ``n_days`` (age = end − publish_time, in ms, limit exclusive)."""
    limit = F.when(F.col(size_col) == 1, F.lit(int(n1_days * DAY_MS))).otherwise(F.lit(int(n_days * DAY_MS)))
    return clusters.where(F.lit(end_ms) - F.col(time_col) <= limit)


def daily_counts(df: DataFrame, day_col: Column, min_batch: int = 100) -> DataFrame:
    """One batch per local day; small days are flagged, not skipped."""
    return (df.groupBy(day_col.alias("day"))
              .agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
              .withColumn("small", (F.col("n") < min_batch).cast("int")))


def slot_batches(df: DataFrame, start_ms: int, gap_ms: int, min_batch: int = 100,
                 ms_col: str = "publishAt") -> DataFrame:
    """Adaptive history windows.

    Rows fall in fixed slots of ``gap_ms`` from ``start_ms``.  A batch grows
    one slot at a time from its start until it holds ≥ ``min_batch`` rows;
    then the next batch starts.  Returns (slot, n, batch, complete).

    The per-slot counts are a partial aggregate over all rows.  The ordered
    fold streams over the slot counts alone (one row per time slot, however
    many rows fall in it) and keeps two numbers.
    """
    slot = F.floor((F.col(ms_col) - F.lit(start_ms)) / F.lit(gap_ms)).cast("long")
    counts = df.where(F.col(ms_col) >= start_ms).groupBy(slot.alias("slot")).agg(F.count("*").alias("n"))

    def fold(frames):
        batch = held = 0
        for frame in frames:
            batches, sums = [], []
            for n in frame["n"]:
                batch, held = (batch + 1, n) if held >= min_batch else (batch, held + n)
                batches.append(batch)
                sums.append(held)
            yield frame.assign(batch=batches, acc=sums)

    rows = counts.repartition(1).sortWithinPartitions("slot").mapInPandas(fold, "slot long, n long, batch long, acc long")
    done = rows.groupBy("batch").agg((F.max("acc") >= min_batch).cast("int").alias("complete"))
    return rows.join(done, "batch").select("slot", "n", "batch", "complete")


def tumbling_counts(df: DataFrame, ts_col: str, width: str) -> DataFrame:
    """Row counts per tumbling window (``'4 hours'``, ``'1 day'``)."""
    return (df.groupBy(F.window(ts_col, width).alias("w"))
              .agg(F.count("*").alias("n"))
              .select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n"))


def read_mark(spark: SparkSession, root: str, default_ms: int) -> int:
    """The last committed progress mark (epoch ms) under ``root``, or
    ``default_ms`` (e.g. now − 1 day) when none was written yet.  Marks are
    one-row parquet files in versioned folders; the highest version wins."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/v=*")
    if not pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern):
        return default_ms
    row = spark.read.parquet(f"{root}/v=*").agg(F.max_by("mark", "version").alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else default_ms


def write_mark(spark: SparkSession, root: str, version: int, mark_ms: int) -> None:
    """Commit a progress mark after a batch succeeded (new version folder,
    never overwriting the one being read)."""
    spark.createDataFrame([(version, mark_ms)], "version long, mark long") \
         .write.mode("overwrite").parquet(f"{root}/v={version:012d}")


def days_ago(now_ms: int, n: float) -> int:
    """Epoch ms ``n`` days before ``now_ms`` (``now`` is a parameter, never
    the wall clock, so tested queries are reproducible)."""
    return int(now_ms - n * DAY_MS)
