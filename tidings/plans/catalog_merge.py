"""Cluster merge (C9–C13) and sink (K1–K3) queries.

Stand-in clusters: documents grouped by (source, lang); order = size desc,
then first member; title keywords = top-5 title words, content keywords =
top-5 of Σ member term counts / size (member terms = each document's top-20
raw content terms).  Editor status: the cluster id (first member doc) is
'1' when ``labels.quality`` = 1, '0' when 0, unknown otherwise.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clustering as CL
from ..operators import features as FE
from ..operators.features import token_features
from ..operators.merge_fold import merge_fold, merged_records, tombstones
from ..session import stored
from . import standins as S
from .registry import query


def members(spark, sf_dir):
    a = S.articles(spark, sf_dir)
    d = S.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    a = a.drop("content").join(d, "id").withColumn("seg_title", S.seg(F.col("title"))).withColumn("seg_content", S.empty_seg())
    a = token_features(a, stop_words=S.STOP_WORDS)
    return a.select(F.concat_ws("/", "dataSource", "lang").alias("cluster_id"), "id", "pos", "title", "publishAt",
                    "title_words")


def clusters(spark, sf_dir, m=None):
    """One row per cluster, written once: its readers use it several times."""
    m = stored(members(spark, sf_dir)) if m is None else m
    rec = CL.cluster_record(m)
    kw = CL.title_keywords(m)
    # Members hold a row for every pair of documents with one id: each text counts once per document of its id.
    top = FE.ranked_terms(S.raw_terms(spark, sf_dir), "id", 20)
    same_id = S.articles(spark, sf_dir).groupBy("id").agg(F.count("*").alias("copies"))
    mk = (top.join(same_id, "id").join(m.select("cluster_id", "id", "pos"), "id")
             .select("cluster_id", "pos", "rank", F.col("term").alias("word"), (F.col("tf") * F.col("copies")).alias("weight")))
    ck = CL.content_keywords(mk, rec.select("cluster_id", "size"))
    return stored(rec.join(kw, "cluster_id", "left").join(ck, "cluster_id", "left")
               .select("cluster_id", "id", "size", "first_pos", F.struct((-F.col("size")).alias("s"), F.col("first_pos").alias("p")).alias("order"),
                       F.coalesce("keywords", F.array().cast("array<string>")).alias("keywords"),
                       F.coalesce("content_keywords", F.array().cast("array<string>")).alias("content_keywords")))


def status(spark, sf_dir):
    lab = S.table(spark, sf_dir, "labels")
    return lab.select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "1").otherwise("0").alias("status"))


CLUSTERS_SQL = f"""{S.ARTICLES_SQL},
members AS (
  SELECT a.dataSource || '/' || d.lang AS cluster_id, a.id, a.pos, a.title, a.publishAt, a.content,
         list_transform(list_filter({S.seg_sql('a.title')},
             lambda t: (NOT list_contains({S.stop_sql()}, t.word) AND starts_with(t.nature, 'n'))
                       OR starts_with(t.nature, 'v')), lambda t: t.word) AS title_words
  FROM articles a JOIN documents d ON d.doc_id = a.id),
kw_counts AS (
  SELECT m.cluster_id, u.w AS word, count(*) AS cnt, min(m.pos * 1000000 + u.i) AS first
  FROM members m, (SELECT unnest(m.title_words) AS w, generate_subscripts(m.title_words, 1) AS i) u GROUP BY 1, 2),
kw AS (SELECT cluster_id, list(word ORDER BY rank) AS keywords FROM (
  SELECT cluster_id, word, row_number() OVER (PARTITION BY cluster_id ORDER BY cnt DESC, first) AS rank FROM kw_counts)
  WHERE rank <= 5 GROUP BY 1),
rec AS (SELECT cluster_id, arg_min(id, pos) AS id, count(*) AS size, min(pos) AS first_pos FROM members GROUP BY 1),
terms AS (
  SELECT id, term, count(*) AS tf, min(i) AS first FROM (
    SELECT id, unnest(l) AS term, generate_subscripts(l, 1) AS i FROM (
      SELECT id, list_transform(regexp_extract_all(coalesce(content, ''), '[A-Za-z]+'), lambda x: lower(x)) AS l FROM members))
  GROUP BY 1, 2),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY tf DESC, first) AS rank FROM terms) WHERE rank <= 20),
ck_s AS (
  SELECT m.cluster_id, t.term AS word, sum(t.tf) / any_value(r.size) AS score, min(m.pos * 1000 + t.rank) AS first
  FROM top t JOIN members m USING (id) JOIN rec r USING (cluster_id) GROUP BY 1, 2),
ck AS (SELECT cluster_id, list(word ORDER BY r) AS content_keywords FROM (
  SELECT cluster_id, word, row_number() OVER (PARTITION BY cluster_id ORDER BY score DESC, first) AS r FROM ck_s)
  WHERE r <= 5 GROUP BY 1),
cl AS (SELECT r.cluster_id, r.id, r.size, r.first_pos, coalesce(k.keywords, []) AS keywords,
              coalesce(c.content_keywords, []) AS content_keywords
       FROM rec r LEFT JOIN kw k USING (cluster_id) LEFT JOIN ck c USING (cluster_id)),
big AS (SELECT * FROM cl WHERE size > 3),
mp AS (
  SELECT j.cluster_id AS j, i.cluster_id AS i,
         len(list_intersect(i.keywords, j.keywords)) AS title_overlap,
         len(list_intersect(i.content_keywords, j.content_keywords)) AS content_overlap,
         len(list_distinct(i.keywords)) AS t, len(list_distinct(i.content_keywords)) AS c
  FROM big i JOIN big j ON (j.size > i.size OR (j.size = i.size AND j.first_pos < i.first_pos))
  WHERE len(list_intersect(list_concat(i.keywords, i.content_keywords), list_concat(j.keywords, j.content_keywords))) > 0),
pairs AS (
  SELECT j, i, title_overlap, content_overlap FROM mp
  WHERE title_overlap >= floor(0.6 * t) OR content_overlap >= floor(0.8 * c)
     OR (title_overlap >= floor(0.4 * t) AND content_overlap >= floor(0.5 * c))
     OR (title_overlap >= floor(0.2 * t) AND content_overlap >= floor(0.6 * c)))"""


@query("content_keywords", f"""WITH {CLUSTERS_SQL}
SELECT cluster_id, array_to_string(content_keywords, ',') AS content_keywords FROM cl""")
def content_keywords_q(spark, sf_dir):
    c = clusters(spark, sf_dir)
    return c.select("cluster_id", F.array_join("content_keywords", ",").alias("content_keywords"))


@query("merge_pairs", f"WITH {CLUSTERS_SQL} SELECT j, i, title_overlap, content_overlap FROM pairs")
def merge_pairs_q(spark, sf_dir):
    return CL.merge_pairs(clusters(spark, sf_dir))


@query("status_protect", f"""WITH {CLUSTERS_SQL},
st AS (SELECT doc_id AS id, CASE WHEN quality = 1 THEN '1' ELSE '0' END AS status FROM labels)
SELECT p.j, p.i, CASE WHEN si.status = '1' AND sj.status = '1' THEN 'stop'
                      WHEN si.status = '1' AND sj.status = '0' THEN 'swap' ELSE 'merge' END AS action
FROM pairs p JOIN cl ci ON ci.cluster_id = p.i JOIN cl cj ON cj.cluster_id = p.j
LEFT JOIN st si ON si.id = ci.id LEFT JOIN st sj ON sj.id = cj.id""")
def status_protect_q(spark, sf_dir):
    """What the editor status does to each candidate merge."""
    c = clusters(spark, sf_dir)
    st = status(spark, sf_dir)
    p = CL.merge_pairs(c)
    ids = c.select("cluster_id", "id")
    j = (p.join(ids.select(F.col("cluster_id").alias("i"), F.col("id").alias("i_id")), "i")
          .join(ids.select(F.col("cluster_id").alias("j"), F.col("id").alias("j_id")), "j")
          .join(st.select(F.col("id").alias("i_id"), F.col("status").alias("si")), "i_id", "left")
          .join(st.select(F.col("id").alias("j_id"), F.col("status").alias("sj")), "j_id", "left"))
    action = (F.when((F.col("si") == "1") & (F.col("sj") == "1"), "stop")
               .when((F.col("si") == "1") & (F.col("sj") == "0"), "swap").otherwise("merge"))
    return j.select("j", "i", action.alias("action"))


def folded(spark, sf_dir):
    """C10 + C12: clusters, members and the exact fold with keywords that change and editor protection."""
    m = stored(members(spark, sf_dir))
    c = clusters(spark, sf_dir, m)
    words = (m.select("cluster_id", "pos", F.posexplode("title_words").alias("at", "word")).groupBy("cluster_id", "word")
             .agg(F.count("*").alias("cnt"), F.min(F.struct("pos", "at")).alias("first")))
    return m, c, merge_fold(c, words, status(spark, sf_dir))


@query("merge_clusters")
def merge_clusters_q(spark, sf_dir):
    """C10 + C12: who joined whom, and the keywords and id after all merges."""
    return folded(spark, sf_dir)[2].withColumn("keywords", F.array_join("keywords", ","))


@query("tombstones")
def tombstones_q(spark, sf_dir):
    """Delete rows for the ids that merges free."""
    return tombstones(folded(spark, sf_dir)[2])


@query("cluster_members", f"WITH {CLUSTERS_SQL} SELECT cluster_id, id AS member_id, pos FROM members")
def cluster_members_q(spark, sf_dir):
    """K3: cluster → member ids, one row per member (never one list per cluster)."""
    return members(spark, sf_dir).select("cluster_id", F.col("id").alias("member_id"), "pos")


@query("cluster_log", f"""WITH {CLUSTERS_SQL}
SELECT 0 AS batch_id, cluster_id, size AS hot, id, array_to_string(keywords, ',') AS keywords FROM cl""")
def cluster_log_q(spark, sf_dir):
    """K1: cluster log rows of one batch."""
    c = clusters(spark, sf_dir)
    return c.select(F.lit(0).alias("batch_id"), "cluster_id", F.col("size").alias("hot"), "id",
                    F.array_join("keywords", ",").alias("keywords"))


@query("cluster_upsert", f"""WITH {S.STREAM_SQL},
log AS (SELECT strftime(make_timestamp((publishAt + 28800000) * 1000), '%Y%m%d') AS batch_id, user_id AS id,
               count(*) AS hot, max(publishAt) AS publishAt FROM stream GROUP BY 1, 2)
SELECT id, batch_id, hot, publishAt FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY batch_id DESC) AS rn FROM log) WHERE rn = 1""")
def cluster_upsert_q(spark, sf_dir):
    """K2: latest row per cluster id over an append-only log of daily batches."""
    from ..operators.sinks import latest_per_id
    from ..functions.text import format_ms
    st = S.stream(spark, sf_dir)
    log = (st.groupBy(format_ms(F.col("publishAt"), "yyyyMMdd").alias("batch_id"), F.col("user_id").alias("id"))
             .agg(F.count("*").alias("hot"), F.max("publishAt").alias("publishAt")))
    return latest_per_id(log, "id", "batch_id").select("id", "batch_id", "hot", "publishAt")


@query("merged_clusters")
def merged_clusters_q(spark, sf_dir):
    """C11: cluster attributes after the keyword merge."""
    m, c, fold = folded(spark, sf_dir)
    return merged_records(m, c, fold).withColumn("keywords", F.array_join("keywords", ",")).select(
        "cluster_id", "id", "size", "keywords", "title", "publish_time", "min_publishtime", "max_publishtime")


@query("cluster_report")
def cluster_report_q(spark, sf_dir):
    """K5: one report line per cluster (title, hot, keywords, number of hot
    event clusters among its core events)."""
    from ..operators import events as EV
    from ..operators.sinks import report_lines
    from .catalog_events import BLOCK, TOLD, stored_events
    merged = EV.event_merge(stored_events(spark, sf_dir, TOLD), None, ["cluster_id"], block_fields=BLOCK)
    hot = EV.hot_events(EV.event_stats(merged, ["cluster_id"]), ["cluster_id"], 1)
    from .catalog_clusters import source_members
    m = source_members(spark, sf_dir)
    summary = CL.cluster_record(m).join(CL.title_keywords(m), "cluster_id").join(CL.title_pick(m, CL.title_keywords(m)), "cluster_id")
    return report_lines(summary, hot)
