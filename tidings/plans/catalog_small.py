"""Filters and features of the older job versions, size order, article text and the event re-scan."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clustering as CL
from ..operators import events as EV
from ..operators import features as FE
from ..functions.text import text_of
from ..streaming.live import scratch_root
from . import catalog_annotate as CA
from . import catalog_clusters as CC
from . import catalog_events as CE
from . import catalog_features as CF
from . import catalog_vectors as CV
from . import standins as S
from .registry import query

ENTITIES = ("stone", "river", "light", "haus", "maison")
DROPPED = ("v",)


def _quoted(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


@query("features_v1", f"""WITH {CF.SEGS_SQL}
SELECT id, array_to_string(list_concat(
         list_transform(list_filter(sc, lambda t: list_contains({_quoted(ENTITIES)}, t.word) OR t.nature = 'nz'), lambda t: t.word),
         list_transform(list_filter(st, lambda t: list_contains({_quoted(ENTITIES)}, t.word)), lambda t: t.word)), ' ') AS ners,
       array_to_string(list_transform(list_filter(sc, lambda t: t.nature <> 'v' AND NOT list_contains({S.stop_sql()}, t.word)), lambda t: t.word), ' ') AS words
FROM segs""")
def features_v1_q(spark, sf_dir):
    """entities by list or tag, words neither of a dropped tag nor stop words."""
    f = FE.token_features_v1(CF.seg_articles(spark, sf_dir), stop_words=S.STOP_WORDS, entity_list=ENTITIES, drop_natures=DROPPED)
    return f.select("id", F.array_join("ners", " ").alias("ners"), F.array_join("words", " ").alias("words"))


@query("features_draft", f"""WITH {CA.PARSE_SQL}
SELECT doc_id, s_idx, string_agg(word, ' ' ORDER BY idx) AS ners FROM arcs WHERE ntype IS NOT NULL GROUP BY 1, 2""")
def features_draft_q(spark, sf_dir):
    """the tokens of a sentence whose entity tag is not O."""
    rows = CA.parsed(spark, sf_dir).select("doc_id", "s_idx", FE.tagged_entities(F.col("words"), F.col("netags")).alias("ners"))
    return rows.where(F.size("ners") > 0).select("doc_id", "s_idx", F.array_join("ners", " ").alias("ners"))


_SCORE_SQL = """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
n AS (SELECT label, count(*) AS size FROM e GROUP BY 1),
p AS (SELECT a.label, sum(list_cosine_similarity(a.v, b.v)) AS s FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id GROUP BY 1),
sc AS (SELECT n.label AS cluster_id, n.size, CASE WHEN n.size = 1 THEN 1.0 ELSE coalesce(p.s, 0) / (n.size * n.size - n.size) END AS score
       FROM n LEFT JOIN p USING (label))"""


@query("score_filter", f"""{_SCORE_SQL}
SELECT cluster_id, size FROM sc WHERE score >= 0 OR cluster_id < 2""")
def score_filter_q(spark, sf_dir):
    """Clusters with a low score go unless they are retained (stand-in: labels as clusters, the first two retained)."""
    e = CV.emb(spark, sf_dir).withColumnRenamed("label", "cluster_id")
    scores = CL.cluster_score(e, "v", CV.V.vector_dim(e, "v"))
    return CL.score_filter(scores, 0.0, F.col("cluster_id") < 2).select("cluster_id", "size")


@query("clusters_by_size", f"""WITH {S.ARTICLES_SQL}{CC.MEMBERS_SQL},
rec AS (SELECT cluster_id, count(*) AS size, min(pos) AS first_pos FROM members GROUP BY 1)
SELECT cluster_id, size, row_number() OVER (ORDER BY size DESC, first_pos) - 1 AS ord FROM rec""")
def clusters_by_size_q(spark, sf_dir):
    """Clusters in order of falling size."""
    return CL.by_size(CL.cluster_record(CC.source_members(spark, sf_dir))).select("cluster_id", "size", "ord")


@query("article_text", f"""WITH {S.ARTICLES_SQL}
SELECT id, coalesce(title, '') || ' ' || coalesce(content, '') AS text FROM articles""")
def article_text_q(spark, sf_dir):
    """Title and content as one text."""
    return S.articles(spark, sf_dir).select("id", text_of(F.col("title"), F.col("content")).alias("text"))


@query("event_rescan", f"""WITH {CE.EVENTS_SQL}
SELECT cluster_id, pos, doc_id, sub, verb, obj, tmp_ms, rpt_ms FROM ev WHERE core""")
def event_rescan_q(spark, sf_dir):
    """Core events written as JSON lines and read again."""
    path = scratch_root(spark, "events-jsonl")
    rows = EV.core_filter(CE.stand_in_events(spark, sf_dir))
    rows.select("cluster_id", "pos", "doc_id", "sub", "verb", "obj", "sentence", "tmp_ms", "rpt_ms").write.json(path)
    return EV.read_events(spark, path).drop("sentence")
