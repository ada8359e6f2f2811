"""Cluster attributes: keywords, titles, records, scores, merge predicates.

Membership is a long table ``members(cluster_id, id, pos, ...)``; every
attribute is a grouped aggregate over it.  Top-k uses ``row_number() <= k``
on pre-aggregated (cluster, word) rows: Spark inserts a partial
WindowGroupLimit before the shuffle, so a cluster holding a third of all
rows still ships only k rows per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C


def title_keywords(members: DataFrame, words_col: str = "title_words", k: int = C.KEYWORDS_TOPK,
                   cluster_col: str = "cluster_id") -> DataFrame:
    """(cluster_id, keywords array, n_words): word counts over all member
    titles, top-k by (count desc, first appearance by (member pos, token idx))."""
    counts = (members.select(cluster_col, "pos", F.posexplode(words_col).alias("idx", "word"))
                     .groupBy(cluster_col, "word")
                     .agg(F.count("*").alias("cnt"), F.min(F.struct("pos", "idx")).alias("first")))
    w = Window.partitionBy(cluster_col).orderBy(F.col("cnt").desc(), F.col("first"))
    top = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    kw = top.groupBy(cluster_col).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"]).alias("keywords"))
    return kw


def title_keyword_counts(members: DataFrame, words_col: str = "title_words", cluster_col: str = "cluster_id") -> DataFrame:
    """(cluster_id, word, cnt): the full keyword → count map as rows."""
    return (members.select(cluster_col, F.explode(words_col).alias("word"))
                   .groupBy(cluster_col, "word").agg(F.count("*").alias("cnt")))


def content_keywords(member_keywords: DataFrame, sizes: DataFrame, k: int = C.KEYWORDS_TOPK,
                     cluster_col: str = "cluster_id") -> DataFrame:
    """(cluster_id, content_keywords): Σ keyword weight / cluster size, top-k.

    ``member_keywords`` is (cluster_id, pos, rank, word, weight); ties go to
    the first appearance (member pos, keyword rank).
    """
    agg = (member_keywords.groupBy(cluster_col, "word")
           .agg(F.sum("weight").alias("s"), F.min(F.struct("pos", "rank")).alias("first"))
           .join(sizes, cluster_col)
           .withColumn("score", F.col("s") / F.col("size")))
    w = Window.partitionBy(cluster_col).orderBy(F.col("score").desc(), F.col("first"))
    top = agg.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k)
    return top.groupBy(cluster_col).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("r", "word"))), lambda x: x["word"]).alias("content_keywords"))


def title_pick(members: DataFrame, keywords: DataFrame, words_col: str = "title_words",
               prefer_fewer_words: bool = True, cluster_col: str = "cluster_id") -> DataFrame:
    """(cluster_id, title): member title with the largest overlap of distinct
    title words with the keywords; ties → fewest distinct words (v2 only) →
    first member.  Overlap 0 everywhere → ''.

    ``max_by`` is a partial aggregate, so a hot cluster is reduced map-side.
    """
    j = members.join(keywords, cluster_col, "left")
    ov = F.size(F.array_intersect(F.coalesce(F.col("keywords"), F.array()), F.col(words_col)))
    nw = F.size(F.array_distinct(F.col(words_col)))
    key = F.struct((-ov).alias("ov"), (nw if prefer_fewer_words else F.lit(0)).alias("nw"), F.col("pos").alias("p"))
    # Members without overlap have no key, and min_by passes them over.
    best = j.groupBy(cluster_col).agg(F.min_by(F.col("title"), F.when(ov > 0, key)).alias("title"))
    return best.select(cluster_col, F.coalesce("title", F.lit("")).alias("title"))


def title_pick_recent(members: DataFrame, keywords: DataFrame, words_col: str = "title_words",
                      n_recent: int = 3, cluster_col: str = "cluster_id") -> DataFrame:
    """(cluster_id, title): among the ``n_recent`` newest titles (publishAt
    desc, stable), the one with the largest keyword overlap; later wins ties."""
    w = Window.partitionBy(cluster_col).orderBy(F.col("publishAt").desc(), F.col("pos"))
    recent = members.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n_recent)
    j = recent.join(keywords, cluster_col, "left")
    ov = F.size(F.array_intersect(F.coalesce(F.col("keywords"), F.array()), F.col(words_col)))
    return j.groupBy(cluster_col).agg(F.max_by(F.col("title"), F.struct(ov.alias("o"), F.col("_r").alias("r"))).alias("title"))


def cluster_record(members: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """(cluster_id, id, size, first_pos, publish_time, min/max_publishtime).

    id is the first member's id.  Member lists stay a long table
    (cluster_id, id, pos): a hot cluster is never collected into one row.
    """
    return members.groupBy(cluster_col).agg(
        F.min_by("id", "pos").alias("id"),
        F.count("*").alias("size"),
        F.min("pos").alias("first_pos"),
        F.max("publishAt").alias("publish_time"),
        F.min("publishAt").alias("min_publishtime"),
        F.max("publishAt").alias("max_publishtime"),
    )


def normalize(v: Column) -> Column:
    """Unit vector of an array<double> (zero vectors stay zero)."""
    n = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(v, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def vector_sum(vec_col: str, dim: int) -> Column:
    """Aggregate: element-wise sum of array<double> of fixed length ``dim``."""
    return F.array(*[F.sum(F.col(vec_col)[i]) for i in range(dim)])


def cluster_score(members: DataFrame, vec_col: str, dim: int, cluster_col: str = "cluster_id") -> DataFrame:
    """(cluster_id, size, score): mean cosine over ordered member pairs,
    (‖Σ v̂‖² − n)/(n² − n); singletons score 1.  One aggregate, no self join."""
    unit = members.withColumn("_u", normalize(F.col(vec_col)))
    agg = unit.groupBy(cluster_col).agg(F.count("*").alias("size"), vector_sum("_u", dim).alias("_s"))
    sq = F.aggregate(F.col("_s"), F.lit(0.0), lambda a, x: a + x * x)
    n = F.col("size")
    return agg.select(cluster_col, "size",
                      F.when(n == 1, F.lit(1.0)).otherwise((sq - n) / (n * n - n)).alias("score"))


def score_filter(clusters: DataFrame, threshold: float, retained: Column | None = None, score_col: str = "score") -> DataFrame:
    """Clusters with a score of ``threshold`` at least; retained ones stay whatever their score (v1: 0.5, v2: 0)."""
    good = F.coalesce(F.col(score_col) >= threshold, F.lit(False))
    return clusters.where(good if retained is None else good | F.coalesce(retained, F.lit(False)))


def by_size(clusters: DataFrame, size_col: str = "size", pos_col: str = "first_pos", name: str = "ord") -> DataFrame:
    """``clusters`` with their place by falling size, equal ones in their given order."""
    from .moving_means import ordered_index
    return ordered_index(clusters.withColumn("_order", F.struct((-F.col(size_col)).alias("s"), F.col(pos_col).alias("p"))), "_order", name).drop("_order")


def merge_predicate(tov: Column, cov: Column, t: Column, c: Column, rules=C.MERGE_RULES) -> Column:
    """First true of the keyword-overlap rules; ``t``/``c`` are the later
    cluster's title / content keyword counts (directional, floors may be 0)."""
    out = F.lit(False)
    for ft, fc in rules:
        cond = F.lit(True)
        if ft is not None:
            cond = cond & (tov >= F.floor(F.lit(ft) * t))
        if fc is not None:
            cond = cond & (cov >= F.floor(F.lit(fc) * c))
        out = out | cond
    return out


def zero_floor(t: Column, c: Column, rules=C.MERGE_RULES) -> Column:
    """True when some rule needs no overlap at all (every floor is 0)."""
    out = F.lit(False)
    for ft, fc in rules:
        cond = F.lit(True)
        if ft is not None:
            cond = cond & (F.floor(F.lit(ft) * t) == 0)
        if fc is not None:
            cond = cond & (F.floor(F.lit(fc) * c) == 0)
        out = out | cond
    return out


def merge_pairs(clusters: DataFrame, order_col: str = "order", min_size: int = C.MERGE_MIN_SIZE) -> DataFrame:
    """C9 over clusters(cluster_id, order, size, keywords, content_keywords):
    pairs (earlier j, later i), both of size > ``min_size``, sharing at least
    one keyword, for which the predicate holds with i's list lengths.

    Candidates come from a keyword inverted index (join on the keyword), so
    only clusters with a common keyword meet.
    """
    big = clusters.where(F.col("size") > min_size)
    kw = big.select("cluster_id", order_col,
                    F.explode(F.array_distinct(F.concat(F.col("keywords"), F.col("content_keywords")))).alias("kw"))
    cand = (kw.alias("i").join(kw.alias("j"), "kw")
              .where(F.col(f"j.{order_col}") < F.col(f"i.{order_col}"))
              .select(F.col("i.cluster_id").alias("i"), F.col("j.cluster_id").alias("j")).distinct())
    ci = big.select(F.col("cluster_id").alias("i"), F.col("keywords").alias("ti"), F.col("content_keywords").alias("ki"))
    cj = big.select(F.col("cluster_id").alias("j"), F.col("keywords").alias("tj"), F.col("content_keywords").alias("kj"))
    j = cand.join(ci, "i").join(cj, "j")
    tov = F.size(F.array_intersect("ti", "tj"))
    cov = F.size(F.array_intersect("ki", "kj"))
    return (j.where(merge_predicate(tov, cov, F.size(F.array_distinct("ti")), F.size(F.array_distinct("ki"))))
             .select("j", "i", tov.alias("title_overlap"), cov.alias("content_overlap")))


def merge_clusters(clusters: DataFrame, status: DataFrame | None = None, order_col: str = "order",
                   min_size: int = C.MERGE_MIN_SIZE) -> DataFrame:
    """C10 + C12 (scalable variant): first-fit merge of each big cluster into
    the first earlier accepted cluster it matches, on the clusters' own
    (unmerged) keywords, as exact leader rounds over the C9 pairs.

    Zero-floor clusters match every earlier big cluster, so their only
    useful edge is to the first big cluster.  ``status(id, status)`` marks
    editor-created clusters: a (1, 1) pair does not merge and stops the
    search; (1, 0) merges but the survivor takes the later cluster's id, so it
    is editor-created from then on and the next such cluster stays apart.
    Returns (cluster_id, target, final_id, merged).
    """
    from .leaders import leader_rounds

    big = clusters.where(F.col("size") > min_size)
    pairs = merge_pairs(clusters, order_col, min_size).select(F.col("j").alias("a"), F.col("i").alias("b"))
    first_id = big.select(F.min_by("cluster_id", order_col)).scalar()  # scalar subquery, no join
    zf = (big.where(zero_floor(F.size(F.array_distinct("keywords")), F.size(F.array_distinct("content_keywords"))))
             .select(first_id.alias("a"), F.col("cluster_id").alias("b"))
             .where(F.col("a") != F.col("b")))
    edges = pairs.unionByName(zf).distinct()
    if status is not None:
        st = status.select(F.col("id").alias("_sid"), F.col("status"))
        ids = clusters.select("cluster_id", "id")
        e = (edges.join(ids.select(F.col("cluster_id").alias("a"), F.col("id").alias("a_id")), "a")
                  .join(ids.select(F.col("cluster_id").alias("b"), F.col("id").alias("b_id")), "b")
                  .join(st.select(F.col("_sid").alias("a_id"), F.col("status").alias("sa")), "a_id", "left")
                  .join(st.select(F.col("_sid").alias("b_id"), F.col("status").alias("sb")), "b_id", "left"))
        edges = e.select("a", "b", F.coalesce((F.col("sb") == "1") & (F.col("sa") == "1"), F.lit(False)).alias("stop"),
                         F.coalesce((F.col("sb") == "1") & (F.col("sa") == "0"), F.lit(False)).alias("claim"))
    nodes = clusters.select(F.col("cluster_id").alias("node"), F.col(order_col).alias("pos"))
    lead = leader_rounds(nodes, edges)
    res = lead.select(F.col("node").alias("cluster_id"), F.col("leader").alias("target"))
    res = res.join(clusters.select("cluster_id", "id"), "cluster_id")
    if status is not None:
        # (1, 0): the survivor j takes i's id when i is editor-created and j is not.
        st = status.select(F.col("id"), F.col("status"))
        tgt = clusters.select(F.col("cluster_id").alias("target"), F.col("id").alias("target_id"))
        res = (res.join(tgt, "target")
                  .join(st.select(F.col("id"), F.col("status").alias("s_self")), "id", "left")
                  .join(st.select(F.col("id").alias("target_id"), F.col("status").alias("s_target")), "target_id", "left"))
        swap = (F.col("target") != F.col("cluster_id")) & (F.col("s_self") == "1") & (F.col("s_target") == "0")
        res = res.withColumn("swap", swap)
    else:
        res = res.join(clusters.select(F.col("cluster_id").alias("target"), F.col("id").alias("target_id")), "target") \
                 .withColumn("swap", F.lit(False))
    return res.select("cluster_id", "id", "target", "target_id", (F.col("target") != F.col("cluster_id")).alias("merged"), "swap")


def tombstones(merge: DataFrame) -> DataFrame:
    """Delete rows (id, hot 0, delFlag 1) for merged clusters.  In the
    protected (1, 0) case the survivor took the merged cluster's id, so the
    tombstone carries the survivor's old id."""
    m = merge.where("merged")
    return m.select(F.when(F.col("swap"), F.col("target_id")).otherwise(F.col("id")).alias("id"),
                    F.lit(0).alias("hot"), F.lit(1).alias("delFlag"))


def merged_attributes(members: DataFrame, merge: DataFrame, clusters: DataFrame, words_col: str = "title_words",
                      order_col: str = "order", k: int = C.KEYWORDS_TOPK) -> DataFrame:
    """C11/C14: attributes of the clusters after merging, recomputed from the
    merged membership: keywords recounted over all member titles (the
    surviving cluster's members first), title by max overlap then first
    (C6b), time span from all members; id follows the editor swap.

    ``merge`` is the output of :func:`merge_clusters`.
    """
    ordmap = clusters.select("cluster_id", F.col(order_col).alias("_ord"))
    m = (members.join(merge.select("cluster_id", "target"), "cluster_id")
                .join(ordmap, "cluster_id")
                .withColumn("_own", (F.col("cluster_id") != F.col("target")).cast("int"))
                .withColumn("pos", F.struct("_own", "_ord", F.col("pos").alias("p")))
                .withColumn("cluster_id", F.col("target")))
    kw = title_keywords(m, words_col, k)
    title = title_pick(m, kw, words_col, prefer_fewer_words=False)
    span = m.groupBy("cluster_id").agg(F.count("*").alias("size"), F.max("publishAt").alias("publish_time"),
                                       F.min("publishAt").alias("min_publishtime"),
                                       F.max("publishAt").alias("max_publishtime"))
    ids = (merge.where(F.col("cluster_id") == F.col("target"))
                .select("cluster_id", "id")
                .join(merge.where("swap").groupBy(F.col("target").alias("cluster_id"))
                           .agg(F.min_by("id", "cluster_id").alias("_swapped")), "cluster_id", "left")
                .select("cluster_id", F.coalesce("_swapped", "id").alias("id")))
    return (span.join(ids, "cluster_id").join(kw, "cluster_id", "left").join(title, "cluster_id", "left"))
