"""Streaming queries (W1–W5): the events table replayed as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import format_ms
from ..session import DAY_MS, ntz_to_ms, stored
from ..streaming import live
from ..streaming.clusters import LiveRules, by_key, run_stream
from ..streaming.state import VersionedStore
from . import standins as S
from .registry import query


def _events_stream(spark, sf_dir):
    """Events as a stream with an instant event time (``ets``) for watermarks."""
    schema = S.table(spark, sf_dir, "events").schema
    s = live.read_table_stream(spark, sf_dir, "events.parquet", schema)
    return s.withColumn("ets", F.timestamp_millis(ntz_to_ms(F.col("ts"))))


@query("stream_dedup", """SELECT event_id AS id, epoch_us(ts) // 1000 AS publishAt, user_id, event_type FROM events""")
def stream_dedup_q(spark, sf_dir):
    """W1 + W2: micro-batches with a 36 h watermark dropping repeated ids."""
    root = live.scratch_root(spark, "dedup")
    s = live.dedup_late(_events_stream(spark, sf_dir), "ets", "event_id", "36 hours")
    s = s.select(F.col("event_id").alias("id"), ntz_to_ms(F.col("ts")).alias("publishAt"), "user_id", "event_type")
    live.run_batches(s, root, "append")
    return live.read_batches(spark, root).drop("batch_id")


@query("stream_windows", """SELECT strftime(time_bucket(INTERVAL 4 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       count(*) AS n FROM events GROUP BY 1""")
def stream_windows_q(spark, sf_dir):
    """4 h tumbling counts in update mode, upserted per window."""
    root = live.scratch_root(spark, "windows")
    s = live.windowed_counts(_events_stream(spark, sf_dir), "ets", "4 hours", "36 hours")
    s = s.select(format_ms(F.unix_millis("w.start"), "yyyy-MM-dd HH:mm:ss", "UTC").alias("window_start"), "n")
    live.run_batches(s, root, "update")
    return live.latest_per_key(live.read_batches(spark, root), ["window_start"]).select("window_start", "n")


# ---- the live job with state of its own ---------------------------------------------------
#
# Stand-in deliveries: events arrive week by week.  Errors come a week late, and
# what lies in a week's last day is delivered again with the next week.

WEEK_MS = 7 * DAY_MS
LATE_TYPE = "error"
LIVE = LiveRules(look_back_days=8)
_FILES = 12


def deliveries(spark, sf_dir):
    """Events as articles with the number of the delivery that brings them."""
    e = S.stream(spark, sf_dir)
    since = F.col("publishAt") - F.lit(S.BASE_MS)
    week = F.floor(since / WEEK_MS).cast("int")
    rows = e.select("id", "publishAt", "user_id", F.col("event_type").alias("title"), F.array("event_type").alias("title_words"),
                    week.alias("week"), (since % WEEK_MS >= 6 * DAY_MS).alias("last_day"))
    late = F.col("title") == LATE_TYPE
    numbers = F.when(late, F.array(F.col("week") + 1)).when(F.col("last_day"), F.array(F.col("week"), F.col("week") + 1)).otherwise(F.array("week"))
    return rows.withColumn("delivery", F.explode(numbers)).drop("week", "last_day")


def delivered_stream(spark, table, root):
    """The deliveries written one after the other, read as a stream of one delivery per batch."""
    # Every delivery reads the table again: its rows are made once.
    table = stored(table)
    last = table.agg(F.max("delivery")).first()[0]
    for number in range((-1 if last is None else last) + 1):
        table.where(F.col("delivery") == number).drop("delivery").repartition(_FILES).write.mode("append").parquet(f"{root}/inbox")
    schema = table.drop("delivery").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", _FILES).parquet(f"{root}/inbox")


def live_run(spark, sf_dir):
    root = live.scratch_root(spark, "clusters")
    store = VersionedStore(spark, f"{root}/store")
    run_stream(delivered_stream(spark, deliveries(spark, sf_dir), root), store, by_key("user_id"), LIVE)
    return store


LIVE_SQL = f"""WITH RECURSIVE e AS (
  SELECT event_id AS id, epoch_us(ts) // 1000 AS p, user_id AS key, event_type,
         (epoch_us(ts) // 1000 - {S.BASE_MS}) // {WEEK_MS} AS w, (epoch_us(ts) // 1000 - {S.BASE_MS}) % {WEEK_MS} AS off FROM events),
d AS (
  SELECT id, p, CASE WHEN event_type = '{LATE_TYPE}' THEN w + 1 ELSE w END AS b FROM e
  UNION ALL SELECT id, p, w + 1 FROM e WHERE event_type <> '{LATE_TYPE}' AND off >= {6 * DAY_MS}),
clock AS (SELECT b, max(max(p)) OVER (ORDER BY b) AS end_ms FROM d GROUP BY b),
taken AS (SELECT id, min(b) AS b FROM d JOIN clock USING (b) WHERE p > end_ms - {8 * DAY_MS} GROUP BY id),
fresh AS (SELECT c.b, count(t.id) AS n FROM clock c LEFT JOIN taken t USING (b) GROUP BY 1),
gate AS (
  SELECT b, n AS held, n >= {LIVE.min_batch} AS pass FROM fresh WHERE b = 0
  UNION ALL
  SELECT f.b, f.n + CASE WHEN g.pass THEN 0 ELSE g.held END, f.n + CASE WHEN g.pass THEN 0 ELSE g.held END >= {LIVE.min_batch}
  FROM gate g JOIN fresh f ON f.b = g.b + 1),
placed AS (SELECT t.id, min(g.b) AS b FROM taken t JOIN gate g ON g.b >= t.b AND g.pass GROUP BY 1),
agg AS (
  SELECT q.b, e.key, count(*) AS n, max(e.p) AS mx, min(e.p) AS mn, first(e.id ORDER BY e.p, e.id) AS first_id
  FROM placed q JOIN e USING (id) GROUP BY 1, 2),
state AS (
  SELECT -1::BIGINT AS b, key, NULL::BIGINT AS first_id, NULL::BIGINT AS size, NULL::BIGINT AS pt, NULL::BIGINT AS mn FROM (SELECT DISTINCT key FROM e)
  UNION ALL
  SELECT b, key, CASE WHEN alive THEN first_id ELSE a_first END, CASE WHEN alive THEN size + coalesce(a_n, 0) ELSE a_n END,
         CASE WHEN alive THEN greatest(pt, coalesce(a_mx, pt)) ELSE a_mx END, CASE WHEN alive THEN least(mn, coalesce(a_mn, mn)) ELSE a_mn END
  FROM (
    SELECT g.b, s.key, s.first_id, s.size, s.pt, s.mn, a.n AS a_n, a.mx AS a_mx, a.mn AS a_mn, a.first_id AS a_first,
           s.size IS NOT NULL AND (NOT g.pass OR c.end_ms - s.pt <= {DAY_MS}) AS alive
    FROM state s JOIN gate g ON g.b = s.b + 1 JOIN clock c ON c.b = g.b LEFT JOIN agg a ON a.b = g.b AND a.key = s.key))"""


@query("cluster_state", f"""{LIVE_SQL}
SELECT first_id::VARCHAR AS cluster, first_id AS id, size, pt AS publish_time, mn AS min_publishtime
FROM state WHERE b = (SELECT max(b) FROM gate) AND size IS NOT NULL""")
def cluster_state_q(spark, sf_dir):
    """The retained clusters after all deliveries, with repeats, late rows, waiting and expiry."""
    return live_run(spark, sf_dir).read("clusters").select("cluster", "id", "size", "publish_time", "min_publishtime")


@query("cluster_state_log", f"""{LIVE_SQL}
SELECT s.b AS batch_id, s.first_id::VARCHAR AS cluster, s.size AS hot, s.pt AS publishAt
FROM state s JOIN gate g ON g.b = s.b AND g.pass WHERE s.size > {LIVE.save_above}""")
def cluster_state_log_q(spark, sf_dir):
    """The log rows of all committed batches, clusters above the save threshold."""
    return live_run(spark, sf_dir).history("log").select("batch_id", "cluster", "hot", "publishAt")
