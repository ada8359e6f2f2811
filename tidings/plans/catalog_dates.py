"""Date queries (D1–D7) over stand-in sentences built from ``events``.

Each event row becomes one Chinese sentence stating its own local (UTC+8)
date in one of three shapes, chosen by ``value``: a dateline
('{Y}年{M}月{D}日电 …', value < 20), a month-day event date ('{M}月{D}日 …',
value < 50) or a bare day ('… 记录{D}日').  publishAt = the event time.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..session import local_wall_time
from . import standins as S
from .registry import query


def sentences(spark, sf_dir):
    st = S.stream(spark, sf_dir)
    w = local_wall_time(F.col("publishAt"))
    y, m, d = F.year(w).cast("string"), F.month(w).cast("string"), F.dayofmonth(w).cast("string")
    s = (F.when(F.col("value") < 20, F.concat(y, F.lit("年"), m, F.lit("月"), d, F.lit("日电 "), F.col("event_type")))
          .when(F.col("value") < 50, F.concat(m, F.lit("月"), d, F.lit("日 "), F.col("event_type")))
          .otherwise(F.concat(F.col("event_type"), F.lit(" 记录"), d, F.lit("日"))))
    return st.select("id", "publishAt", s.alias("s"))


SENT_SQL = f"""{S.STREAM_SQL},
w AS (SELECT id, publishAt, value, event_type, make_timestamp((publishAt + 28800000) * 1000) AS lt FROM stream),
sents AS (SELECT id, publishAt,
  CASE WHEN value < 20 THEN CAST(year(lt) AS VARCHAR) || '年' || CAST(month(lt) AS VARCHAR) || '月' || CAST(day(lt) AS VARCHAR) || '日电 ' || event_type
       WHEN value < 50 THEN CAST(month(lt) AS VARCHAR) || '月' || CAST(day(lt) AS VARCHAR) || '日 ' || event_type
       ELSE event_type || ' 记录' || CAST(day(lt) AS VARCHAR) || '日' END AS s FROM w)"""


def _rpt_sql() -> str:
    pats = [p.replace("'", "''") for p in D.rpt_patterns()]
    parts = ", ".join(f"nullif(regexp_extract(s, '{p}', 0), '')" for p in pats)
    return f"coalesce({parts})"


@query("date_chunk_rpt", f"WITH {SENT_SQL} SELECT id, {_rpt_sql()} AS rpt_str FROM sents")
def date_chunk_rpt_q(spark, sf_dir):
    """Report-time chunk (first of the three dateline patterns)."""
    s = sentences(spark, sf_dir)
    return s.select("id", D.first_hit(F.col("s"), D.rpt_patterns()).alias("rpt_str"))


@query("date_resolve")
def date_resolve_q(spark, sf_dir):
    """RPT / TMP chunk strings and resolved local-midnight epoch ms
    (event-time patterns use look-ahead, so no DuckDB oracle; goldens in tests)."""
    s = D.with_sentence_times(sentences(spark, sf_dir), "s", "publishAt")
    return s.select("id", "times.rpt_str", "times.tmp_str", "times.rpt_ms", "times.tmp_ms")
