"""Keyword merge of clusters (C9–C13) with keywords that change, exact, in speculative rounds.

Sequential rule: clusters come in order; one above ``min_size`` members joins
the first earlier accepted one (above that size too) whose keywords it
matches.  The accepted cluster's title keywords are then counted anew over
both, which changes what later clusters match; its content keywords stay.

A round assumes who joined whom and folds every accepted cluster's word counts
over its joiners in order.  Each joiner makes a new version of its keywords,
valid up to the next joiner.  An inverted index from keyword to versions gives
every cluster the versions it can match at its place in the order; the first
match decides.  If all decisions equal the assumption they are the sequential
result (by induction each saw the right versions); otherwise they are the next
assumption, and the clusters up to the first that changed are settled.

A cluster looks only under its rarest keywords: a rule that needs ``n`` of its
``m`` keywords cannot hold without one of any ``m - n + 1`` of them.  Clusters
for which a rule needs nothing match the first cluster of all.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..session import cut_lineage
from .clustering import merge_predicate, title_pick, zero_floor
from .moving_means import ordered_index

#: Parts of the order by which versions and clusters are matched.
SPANS = 64
_VERSION = "leader long, since long, until long, version int, keywords array<string>, status string, id string, joiner_swaps boolean, dropped string"


def version_keywords(counts: dict[str, int], place: dict[str, int], newest: dict[str, int], k: int) -> list[str]:
    """The ``k`` most frequent words; ties go to the newest cluster's words in their order, then to those seen first."""
    by_count: dict[int, list[str]] = {}
    for word, n in counts.items():
        by_count.setdefault(n, []).append(word)
    out: list[str] = []
    for n in sorted(by_count, reverse=True):
        words = by_count[n]
        words.sort(key=lambda w: (0, newest[w]) if w in newest else (1, place[w]))
        out += words[:k - len(out)]
        if len(out) == k:
            break
    return out


def _versions(k: int):
    """Versions of every accepted cluster, from rows sorted by cluster and place: itself, then its joiners."""
    names = ["leader", "since", "until", "version", "keywords", "status", "id", "joiner_swaps", "dropped"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.string(), pa.string(), pa.bool_(), pa.string()]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        open_row, leader, counts, place, status, name, number = None, None, {}, {}, None, None, 0
        for batch in batches:
            done = []
            for r in batch.to_pylist():
                if r["leader"] != leader:
                    if open_row is not None:
                        done.append((*open_row[:2], None, *open_row[2:]))
                    leader, counts, place, number = r["leader"], {}, {}, 0
                    status, name, keywords, swaps, dropped = r["status"], r["id"], r["keywords"], False, None
                else:
                    done.append((*open_row[:2], r["idx"], *open_row[2:]))
                    number += 1
                    swaps, dropped = r["status"] == "1" and status == "0", r["id"]
                    if swaps:
                        dropped, status, name = name, "1", r["id"]
                newest = {}
                for at, (word, n) in enumerate(zip(r["words"], r["counts"])):
                    newest[word] = at
                    counts[word] = counts.get(word, 0) + n
                    place.setdefault(word, len(place))
                if number:
                    keywords = version_keywords(counts, place, newest, k)
                open_row = (leader, r["idx"], number, keywords, status, name, swaps, dropped)
            if done:
                yield out(done)
        if open_row is not None:
            yield out([(*open_row[:2], None, *open_row[2:])])
    return run


def _needs(size: Column, fraction: float | None) -> Column:
    return F.lit(0) if fraction is None else F.floor(F.lit(fraction) * size).cast("int")


def _prefix_lengths(rules) -> tuple[Column, Column]:
    """How many of the rarest title and content keywords a cluster has to look under, over all rules."""
    t, c = F.size("ti"), F.size("ci")
    title, content = [F.lit(0)], [F.lit(0)]
    for ft, fc in rules:
        nt, nc = _needs(t, ft), _needs(c, fc)
        pt, pc = t - nt + 1, c - nc + 1
        # One list is enough: the shorter prefix of those that the rule asks of.
        by_title = (nt > 0) & ((nc == 0) | (pt <= pc))
        title.append(F.when(by_title, pt).otherwise(0))
        content.append(F.when((nc > 0) & ~by_title, pc).otherwise(0))
    return F.greatest(*title), F.greatest(*content)


def merge_fold(clusters: DataFrame, words: DataFrame, status: DataFrame | None = None, order_col: str = "order",
               min_size: int = C.MERGE_MIN_SIZE, k: int = C.KEYWORDS_TOPK, rules=C.MERGE_RULES, rounds: list[int] | None = None) -> DataFrame:
    """(cluster_id, id, target, merged, swap, dropped_id, final_id, keywords) of all clusters.

    ``clusters`` (cluster_id, id, size, keywords, content_keywords, order);
    ``words`` (cluster_id, word, cnt, first) counts the title words of every
    cluster, ``first`` giving their order.  ``status`` (id, status) marks
    editor-created clusters: a ('1', '1') pair stays apart and ends the search;
    in a ('1', '0') pair the accepted cluster takes the joiner's id (``swap``).
    ``dropped_id`` is the id that a merge frees: the joiner's, or after a swap
    the one that the accepted cluster had.
    ``keywords`` and ``final_id`` are those of the target after all merges (of
    the cluster itself when it stays).  ``rounds`` collects the changes by round.
    """
    state = F.lit(None).cast("string")
    big = clusters.where(F.col("size") > min_size)
    if status is not None:
        marks = status.select(F.col("id").alias("_id"), F.col("status").cast("string").alias("status"))
        big = big.join(marks, big["id"] == F.col("_id"), "left").drop("_id")
    else:
        big = big.withColumn("status", state)
    counted = (words.groupBy(F.col("cluster_id").alias("_c"))
               .agg(F.array_sort(F.collect_list(F.struct("first", "word", "cnt"))).alias("_w")))
    rows = big.join(counted, big["cluster_id"] == F.col("_c"), "left").select(
        "cluster_id", F.col("id").cast("string").alias("id"), "status", F.col(order_col).alias("_order"),
        F.coalesce("keywords", F.array().cast("array<string>")).alias("keywords"),
        F.coalesce("content_keywords", F.array().cast("array<string>")).alias("content"),
        F.coalesce(F.transform("_w", lambda x: x["word"]), F.array().cast("array<string>")).alias("words"),
        F.coalesce(F.transform("_w", lambda x: x["cnt"].cast("long")), F.array().cast("array<bigint>")).alias("counts"))
    nodes = cut_lineage(ordered_index(rows, "_order").drop("_order"))
    n = nodes.count()
    span = max(1, -(-n // SPANS))
    lists = nodes.select("idx", F.array_distinct("keywords").alias("ti"), F.array_distinct("content").alias("ci"), F.col("status").alias("i_status"))
    # How common a keyword is, over both lists: the rarest first.
    common = (nodes.select(F.explode(F.array_distinct(F.concat("keywords", "content"))).alias("word")).groupBy("word").agg(F.count("*").alias("n")))
    title_n, content_n = _prefix_lengths(rules)
    spread = (lists.select("idx", F.explode(F.array(F.struct(F.lit("t").alias("kind"), F.col("ti").alias("ws"), title_n.alias("take")),
                                                    F.struct(F.lit("c").alias("kind"), F.col("ci").alias("ws"), content_n.alias("take")))).alias("x"))
              .select("idx", "x.kind", "x.take", F.explode("x.ws").alias("word")).where("take > 0").join(common, "word")
              .groupBy("idx", "kind", "take").agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("ws"))
              .select("idx", "kind", F.explode(F.slice("ws", F.lit(1), F.col("take"))).alias("x")).select("idx", "kind", "x.word"))
    free = lists.where(zero_floor(F.size("ti"), F.size("ci"), rules)).select("idx", F.lit("z").alias("kind"), F.lit("").alias("word"))
    looks = cut_lineage(spread.unionByName(free).withColumn("part", F.floor(F.col("idx") / span).cast("long")))
    contents = nodes.select(F.col("idx").alias("c_leader"), F.array_distinct("content").alias("cj"))

    def versions_of(target: DataFrame) -> DataFrame:
        accepted = target.where("target = idx").select(F.col("idx").alias("leader"))
        held = target.join(accepted, target["target"] == F.col("leader"), "left_semi")
        return cut_lineage(nodes.join(held.select("idx", F.col("target").alias("leader")), "idx")
                           .select("leader", "idx", "status", "id", "keywords", "words", "counts")
                           .repartition("leader").sortWithinPartitions("leader", "idx").mapInArrow(_versions(k), _VERSION))

    target = cut_lineage(nodes.select("idx", F.col("idx").alias("target")))
    settled = -1
    while n:
        versions = versions_of(target)
        found = versions.join(contents, F.col("leader") == F.col("c_leader")).select(
            "leader", "since", F.coalesce("until", F.lit(n)).alias("until"), F.array_distinct("keywords").alias("tj"), "cj", F.col("status").alias("j_status"))
        keys = F.concat(F.transform("tj", lambda w: F.struct(F.lit("t").alias("kind"), w.alias("word"))),
                        F.transform("cj", lambda w: F.struct(F.lit("c").alias("kind"), w.alias("word"))),
                        F.when(F.col("leader") == 0, F.array(F.struct(F.lit("z").alias("kind"), F.lit("").alias("word")))).otherwise(F.array()))
        index = (found.where(F.col("until") > settled)
                 .withColumn("part", F.explode(F.sequence(F.floor((F.col("since") + 1) / span).cast("long"), F.floor(F.col("until") / span).cast("long"))))
                 .withColumn("key", F.explode(keys)).select("part", "key.kind", "key.word", "leader", "since", "until", "tj", "cj", "j_status"))
        met = (looks.where(F.col("idx") > settled).join(index, ["part", "kind", "word"])
               .where((F.col("idx") > F.col("since")) & (F.col("idx") <= F.col("until")))
               .groupBy("idx", "leader").agg(F.first("tj").alias("tj"), F.first("cj").alias("cj"), F.first("j_status").alias("j_status"))
               .join(lists, "idx"))
        title, content = F.size(F.array_intersect("ti", "tj")), F.size(F.array_intersect("ci", "cj"))
        match = met.where(merge_predicate(title, content, F.size("ti"), F.size("ci"), rules))
        first = match.groupBy("idx").agg(F.min_by(F.struct("leader", "i_status", "j_status"), "leader").alias("m"))
        apart = F.coalesce((F.col("m.i_status") == "1") & (F.col("m.j_status") == "1"), F.lit(False))
        decided = cut_lineage(target.where(F.col("idx") > settled).select("idx", F.col("target").alias("was")).join(first, "idx", "left")
                              .select("idx", F.when(F.col("m").isNotNull() & ~apart, F.col("m.leader")).otherwise(F.col("idx")).alias("target"), "was"))
        changed, at = decided.where("target != was").agg(F.count("*"), F.min("idx")).first()
        target = cut_lineage(target.where(F.col("idx") <= settled).unionByName(decided.drop("was")))
        if rounds is not None:
            rounds.append(changed)
        if not changed:
            break
        settled = at
    versions = versions_of(target)
    last = versions.groupBy("leader").agg(F.max_by(F.struct("keywords", "id"), "version").alias("v"))
    swaps = versions.where("version > 0").select(F.col("since").alias("s_idx"), "joiner_swaps", "dropped")
    names = nodes.select(F.col("idx").alias("t_idx"), F.col("cluster_id").alias("target_cluster"))
    merged = (nodes.select("idx", "cluster_id").join(target, "idx").join(names, F.col("target") == F.col("t_idx"))
              .join(last, F.col("target") == F.col("leader")).join(swaps, F.col("idx") == F.col("s_idx"), "left")
              .select("cluster_id", F.col("target_cluster").alias("target"), (F.col("idx") != F.col("target")).alias("merged"),
                      F.coalesce("joiner_swaps", F.lit(False)).alias("swap"), F.col("dropped").alias("dropped_id"), F.col("v.id").alias("final_id"), F.col("v.keywords").alias("keywords")))
    small = clusters.where((F.col("size") <= min_size) | F.col("size").isNull()).select(
        "cluster_id", F.col("cluster_id").alias("target"), F.lit(False).alias("merged"), F.lit(False).alias("swap"), F.lit(None).cast("string").alias("dropped_id"),
        F.col("id").cast("string").alias("final_id"), F.coalesce("keywords", F.array().cast("array<string>")).alias("keywords"))
    return merged.unionByName(small).join(clusters.select("cluster_id", "id"), "cluster_id").select(
        "cluster_id", "id", "target", "merged", "swap", "dropped_id", "final_id", "keywords")


def tombstones(fold: DataFrame) -> DataFrame:
    """Delete rows (id, hot 0, delFlag 1) for the ids that merges free."""
    return fold.where("merged").select(F.col("dropped_id").alias("id"), F.lit(0).alias("hot"), F.lit(1).alias("delFlag"))


def merged_records(members: DataFrame, clusters: DataFrame, fold: DataFrame, words_col: str = "title_words", order_col: str = "order") -> DataFrame:
    """C11: (cluster_id, id, size, keywords, title, publish_time, min_publishtime, max_publishtime) of the clusters that are left.

    Members are those of the cluster, then those of its joiners in order.  A
    cluster with joiners gets the first title with the largest overlap with
    the new keywords (C6b), one without keeps its own pick (C6a).
    """
    place = clusters.select("cluster_id", F.col(order_col).alias("_order"))
    all_members = (members.join(fold.select("cluster_id", "target"), "cluster_id").join(place, "cluster_id")
                   .withColumn("pos", F.struct((F.col("cluster_id") != F.col("target")).alias("joined"), "_order", "pos"))
                   .withColumn("cluster_id", F.col("target")))
    left = fold.where(~F.col("merged")).select("cluster_id", F.col("final_id").alias("id"), "keywords")
    grown = fold.where("merged").select(F.col("target").alias("cluster_id")).distinct()
    keywords = left.select("cluster_id", "keywords")
    titles = (title_pick(all_members.join(grown, "cluster_id", "left_semi"), keywords, words_col, prefer_fewer_words=False)
              .unionByName(title_pick(all_members.join(grown, "cluster_id", "left_anti"), keywords, words_col)))
    spans = all_members.groupBy("cluster_id").agg(F.count("*").alias("size"), F.max("publishAt").alias("publish_time"),
                                                  F.min("publishAt").alias("min_publishtime"), F.max("publishAt").alias("max_publishtime"))
    return spans.join(left, "cluster_id").join(titles, "cluster_id")
