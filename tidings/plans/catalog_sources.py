"""Source, window, retention and lexicon queries (S*, W5) over events / documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..session import DAY_MS
from ..sources import lexicons as L
from ..sources import scan
from . import standins as S
from .registry import query

HOUR = 3_600_000
WIN_START = S.BASE_MS + 9 * DAY_MS            # 2024-01-10T00:00Z
WIN_LEN = int(1.5 * DAY_MS)                   # live look-back
PREV = (WIN_START, WIN_START + WIN_LEN)
CUR = (WIN_START + 12 * HOUR, WIN_START + 12 * HOUR + WIN_LEN)
RETAIN_END = S.BASE_MS + 19 * DAY_MS          # 2024-01-20T00:00Z


def _ts_sql(ms: int) -> str:
    return f"make_timestamp({ms} * 1000)"


def _window_sql(lo: int, hi: int) -> str:
    return f"SELECT * FROM stream WHERE ts >= {_ts_sql(lo)} AND ts <= {_ts_sql(hi)}"


@query("window_scan", f"""WITH {S.STREAM_SQL}
SELECT id, publishAt, user_id, event_type FROM ({_window_sql(*PREV)})""")
def window_scan_q(spark, sf_dir):
    w = scan.window_scan(S.stream(spark, sf_dir), *PREV)
    return w.select("id", "publishAt", "user_id", "event_type")


@query("delta_antijoin", f"""WITH {S.STREAM_SQL}
SELECT id, publishAt FROM ({_window_sql(*CUR)}) c
WHERE NOT EXISTS (SELECT 1 FROM ({_window_sql(*PREV)}) p WHERE p.id = c.id)""")
def delta_antijoin_q(spark, sf_dir):
    st = S.stream(spark, sf_dir)
    d = scan.delta(scan.window_scan(st, *CUR), scan.window_scan(st, *PREV), "id")
    return d.select("id", "publishAt")


@query("snapshot_after", f"""WITH {S.STREAM_SQL},
cur AS ({_window_sql(*CUR)}), prev AS ({_window_sql(*PREV)}),
n AS (SELECT count(*) AS n FROM cur c WHERE NOT EXISTS (SELECT 1 FROM prev p WHERE p.id = c.id))
SELECT id FROM cur WHERE (SELECT n FROM n) >= 100
UNION ALL
SELECT id FROM prev WHERE (SELECT n FROM n) < 100""")
def snapshot_after_q(spark, sf_dir):
    st = S.stream(spark, sf_dir)
    cur, prev = scan.window_scan(st, *CUR).select("id"), scan.window_scan(st, *PREV).select("id")
    return scan.gated_snapshot(cur, prev, scan.delta(cur, prev, "id"), min_batch=100)


@query("daily_windows", f"""WITH {S.STREAM_SQL}
SELECT strftime(make_timestamp((publishAt + 28800000) * 1000), '%Y-%m-%d') AS day, count(*) AS n,
       min(id) AS first_id, max(id) AS last_id, CASE WHEN count(*) < 100 THEN 1 ELSE 0 END AS small
FROM stream GROUP BY 1""")
def daily_windows_q(spark, sf_dir):
    st = S.stream(spark, sf_dir)
    return scan.daily_counts(st, T.format_ms(F.col("publishAt"), "yyyy-MM-dd"), 100)


@query("slot_batches", f"""WITH RECURSIVE {S.STREAM_SQL},
c AS (SELECT slot, n, row_number() OVER (ORDER BY slot) AS rn FROM (
        SELECT CAST(floor((publishAt - {S.BASE_MS}) / {4 * HOUR}) AS BIGINT) AS slot, count(*) AS n
        FROM stream WHERE publishAt >= {S.BASE_MS} GROUP BY 1)),
r(rn, slot, n, batch, acc) AS (
  SELECT rn, slot, n, 0, n FROM c WHERE rn = 1
  UNION ALL
  SELECT c.rn, c.slot, c.n, CASE WHEN r.acc >= 100 THEN r.batch + 1 ELSE r.batch END,
         CASE WHEN r.acc >= 100 THEN c.n ELSE r.acc + c.n END
  FROM r JOIN c ON c.rn = r.rn + 1)
SELECT slot, n, batch, CAST(max(acc) OVER (PARTITION BY batch) >= 100 AS INTEGER) AS complete FROM r""")
def slot_batches_q(spark, sf_dir):
    return scan.slot_batches(S.stream(spark, sf_dir), S.BASE_MS, 4 * HOUR, 100)


@query("slot_counts", """SELECT strftime(time_bucket(INTERVAL 4 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       count(*) AS n FROM events GROUP BY 1""")
def slot_counts_q(spark, sf_dir):
    return scan.tumbling_counts(S.table(spark, sf_dir, "events"), "ts", "4 hours")


def stand_in_clusters(spark, sf_dir):
    """Stand-in cluster state: one cluster per (user, type, local day)."""
    st = S.stream(spark, sf_dir)
    day = T.format_ms(F.col("publishAt"), "yyyyMMdd")
    return (st.groupBy(F.concat_ws("/", F.col("user_id").cast("string"), "event_type", day).alias("cluster_id"))
              .agg(F.count("*").alias("size"), F.max("publishAt").alias("publish_time")))


@query("retention", f"""WITH {S.STREAM_SQL},
cl AS (SELECT concat_ws('/', CAST(user_id AS VARCHAR), event_type,
                        strftime(make_timestamp((publishAt + 28800000) * 1000), '%Y%m%d')) AS cluster_id,
              count(*) AS size, max(publishAt) AS publish_time FROM stream GROUP BY 1)
SELECT cluster_id, size, publish_time FROM cl
WHERE {RETAIN_END} - publish_time <= CASE WHEN size = 1 THEN {1 * DAY_MS} ELSE {3 * DAY_MS} END""")
def retention_q(spark, sf_dir):
    return scan.retain(stand_in_clusters(spark, sf_dir), RETAIN_END, 1, 3)


def doc_lines(spark, sf_dir):
    """Line table: each document is one lexicon file, its lines in order."""
    d = S.table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("file"), F.posexplode(F.split("text", "\n")).alias("line_no", "value"))


DOC_LINES_SQL = """lines AS (
  SELECT doc_id AS file, unnest(l) AS value, generate_subscripts(l, 1) - 1 AS line_no
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"""

STRIP = "regexp_replace({x}, '^[ \\t\\n\\r\\f]+|[ \\t\\n\\r\\f]+$', '', 'g')"


@query("lexicon_entries", f"""WITH {DOC_LINES_SQL},
cut AS (SELECT file, min(line_no) AS c FROM lines WHERE length({STRIP.format(x='value')}) = 0 GROUP BY 1)
SELECT l.file, l.line_no, split_part({STRIP.format(x='l.value')}, ' ', 1) AS entry
FROM lines l LEFT JOIN cut USING (file) WHERE cut.c IS NULL OR l.line_no < cut.c""")
def lexicon_entries_q(spark, sf_dir):
    return L.lexicon(doc_lines(spark, sf_dir), stop_at_blank=True, first_token=True)


def synonym_lines(spark, sf_dir):
    """Stand-in synonym file: one ``S<doc>=w1 w2 …`` line per document from
    the long (≥ 8 letters) lower-cased words of its title."""
    a = S.articles(spark, sf_dir)
    words = F.filter(F.transform(F.regexp_extract_all("title", F.lit("[A-Za-z]+"), 0), F.lower), lambda w: F.length(w) >= 8)
    return a.select(F.lit("syn").alias("file"), F.col("pos").alias("line_no"),
                    F.concat(F.lit("S"), F.col("id").cast("string"), F.lit("="), F.array_join(words, " ")).alias("value"))


@query("synonym_pairs", f"""WITH {S.ARTICLES_SQL},
lines AS (SELECT 'syn' AS file, pos AS line_no,
                 'S' || CAST(id AS VARCHAR) || '=' || array_to_string(list_filter(
                     list_transform(regexp_extract_all(title, '[A-Za-z]+'), lambda x: lower(x)),
                     lambda w: length(w) >= 8), ' ') AS value FROM articles),
g AS (SELECT line_no, unnest(list_distinct(string_split({STRIP.format(x="split_part(value, '=', 2)")}, ' '))) AS w
      FROM lines WHERE contains(value, '='))
SELECT DISTINCT 'syn' AS file, a.w AS word, b.w AS syn FROM g a JOIN g b USING (line_no)""")
def synonym_pairs_q(spark, sf_dir):
    return L.synonym_pairs(synonym_lines(spark, sf_dir))


@query("jsonl_roundtrip", f"""WITH {S.ARTICLES_SQL}
SELECT id, title, dataSource, publishAt FROM articles""")
def jsonl_roundtrip_q(spark, sf_dir):
    """K6 → S1: articles written as JSON lines (under the shared checkpoint
    folder), read back with the explicit article schema, malformed lines
    dropped and rows without title/content skipped."""
    from ..streaming.live import scratch_root
    path = scratch_root(spark, "articles-jsonl")
    a = S.articles(spark, sf_dir)
    out = a.select(F.col("id").cast("string").alias("id"), "title", "content", "dataSource", "publishAt")
    out.write.mode("overwrite").json(path)
    back = scan.read_articles(spark, path)
    return back.select(F.col("id").cast("long").alias("id"), "title", "dataSource", "publishAt")
