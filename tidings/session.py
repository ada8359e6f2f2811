"""Spark session, checkpointing and time helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Offset of the reference's wall clock (UTC+08:00, no DST since 1991).
DEFAULT_TZ = "Asia/Shanghai"
DAY_MS = 86_400_000


def get_spark(app: str = "tidings", cpus: int | str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE (coalesce + skew join) on and the UI off.

    On a cluster the builder only attaches to the existing session; the
    master and partition settings come from the cluster's own config.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if not os.environ.get("SPARK_MASTER_URL") and not os.environ.get("MASTER"):
        b = b.master(f"local[{cpus}]").config("spark.driver.memory", "16g")
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only when nothing is configured
    (local tests) a fresh scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tidings-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as compressed parquet under the shared checkpoint folder and read back: cuts the lineage like
    a checkpoint, on a fraction of its disk, and later reads take only the columns they use."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ntz_to_ms(ts: Column) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ read as UTC wall time (session-TZ free)."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def local_wall_time(ms: Column, tz: str = DEFAULT_TZ) -> Column:
    """Wall-clock TIMESTAMP_NTZ of epoch ms in ``tz``, independent of the session zone."""
    utc_wall = F.timestamp_add("MILLISECOND", ms, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall)


def local_day_start_ms(ms: Column, tz: str = DEFAULT_TZ) -> Column:
    """Epoch ms of local midnight of the day containing ``ms``."""
    day = F.to_date(local_wall_time(ms, tz))
    return local_ms_of_date(day, tz)


def local_ms_of_date(day: Column, tz: str = DEFAULT_TZ) -> Column:
    """Epoch ms of local midnight of a DATE in ``tz`` (NULL stays NULL)."""
    wall = day.cast("timestamp_ntz")
    utc_wall = F.convert_timezone(F.lit(tz), F.lit("UTC"), wall)
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), utc_wall)
