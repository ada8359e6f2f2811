"""The live clustering job as a stream.

A micro-batch delivers articles, repeats and late ones among them.  The job
keeps its own state between batches: the ids it has taken in the look-back
window, articles that wait because the batch was too small, and the retained
clusters with their members.  One batch

1. takes the delivered articles that lie in the look-back window and whose id
   it does not know (anti join with the window's ids);
2. lets them wait while fewer than ``min_batch`` have come together;
3. else drops clusters that are too old for their size, gives the waiting
   articles in order to the ``assign`` rule together with the retained
   clusters and members, and recomputes the attributes of every cluster from
   its whole membership;
4. writes state, log rows and member rows of the batch and commits them
   together.

The clock is the latest publication time delivered so far, so a replayed
batch does what it did the first time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators import clustering as CL
from ..operators.moving_means import moving_mean_clusters, ordered_index
from ..operators.vectors import centroids
from ..session import DAY_MS, stored
from ..sources.scan import delta, retain
from .state import VersionedStore

#: (retained members, retained clusters, new articles) to (id, cluster): a retained cluster's name, or null where ``opened_by`` names an article.
Assign = Callable[[DataFrame, DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class LiveRules:
    look_back_days: float = 1.5
    min_batch: int = C.MIN_BATCH
    single_days: float = 1
    days: float = 1
    save_above: int = 1


def by_moving_means(vec_col: str, threshold: float = C.CENTROID_THRESHOLD) -> Assign:
    """The cluster with the nearest mean vector, means moving with every member."""
    def assign(members: DataFrame, clusters: DataFrame, new: DataFrame) -> DataFrame:
        sums = centroids(members, "cluster", vec_col).select(
            "cluster", F.transform("centroid", lambda x: x * F.col("n")).alias("total"))
        retained = clusters.select("cluster", "ord").join(sums, "cluster")
        return moving_mean_clusters(new, retained, "id", "pos", vec_col, threshold).select("id", "cluster", "opened_by")
    return assign


def by_key(key_col: str) -> Assign:
    """A given key in place of a similarity: articles of one key form a cluster."""
    def assign(members: DataFrame, clusters: DataFrame, new: DataFrame) -> DataFrame:
        known = members.groupBy(F.col(key_col).alias("_key")).agg(F.max("cluster").alias("cluster"))
        first = new.groupBy(F.col(key_col).alias("_new_key")).agg(F.min_by("id", "pos").alias("_first"))
        return (new.join(known, new[key_col].eqNullSafe(F.col("_key")), "left").join(first, new[key_col].eqNullSafe(F.col("_new_key")))
                .select("id", "cluster", F.when(F.col("cluster").isNull(), F.col("_first")).alias("opened_by")))
    return assign


def attributes(members: DataFrame, words_col: str = "title_words") -> DataFrame:
    """C4, C6a, C7, C8 of all clusters: record, title keywords, title, and ``ord``, the order by falling size (then first member)."""
    named = members.withColumnRenamed("cluster", "cluster_id")
    kw = CL.title_keywords(named, words_col)
    found = CL.cluster_record(named).join(kw, "cluster_id", "left").join(CL.title_pick(named, kw, words_col), "cluster_id")
    # Putting them in order reads them twice: once for the bounds of its ranges.
    return CL.by_size(stored(found)).withColumnRenamed("cluster_id", "cluster")


def run_batch(store: VersionedStore, batch_id: int, rows: DataFrame, assign: Assign, rules: LiveRules = LiveRules(),
              before_commit: Callable[[int], None] | None = None) -> None:
    """One batch of articles (id, publishAt, title, title_words, ...); does nothing if it is committed already.

    Rows without id or time are left out.  An id is taken once, with its
    earliest delivered time; articles are ordered by (publishAt, id).
    """
    if store.committed(batch_id):
        return
    spark = rows.sparkSession
    old = {t: store.read(t, before=batch_id) for t in ("clock", "seen", "waiting", "members", "clusters")}
    # The same rows feed several tables of one version.
    rows = stored(rows.where(F.col("id").isNotNull() & F.col("publishAt").isNotNull()))
    ends = [r for r in (rows.agg(F.max("publishAt")).first()[0], old["clock"] and old["clock"].first()["end_ms"]) if r is not None]
    if not ends:
        return
    end_ms = max(ends)
    clock = spark.range(0, 1, 1, 1).select(F.lit(batch_id).cast("long").alias("batch_id"), F.lit(end_ms).cast("long").alias("end_ms"))
    since = end_ms - int(rules.look_back_days * DAY_MS)
    rest = [c for c in rows.columns if c not in ("id", "publishAt")]
    once = (rows.where(F.col("publishAt") > since).groupBy("id").agg(F.min(F.struct("publishAt", *rest)).alias("r"))
            .select("id", "r.*").select(*rows.columns))
    # What is new goes to the waiting and to the seen ids.
    fresh = stored(delta(once, old["seen"]))
    waiting = fresh if old["waiting"] is None else fresh.unionByName(old["waiting"])
    seen = fresh.select("id", "publishAt")
    if old["seen"] is not None:
        seen = seen.unionByName(old["seen"].where(F.col("publishAt") > since))
    tables = {"clock": clock, "seen": seen, "waiting": waiting}
    written: dict[str, str] = {}

    def kept(name: str, table: DataFrame) -> DataFrame:
        """``table`` written where it stays, and read from there: what follows from it is not another copy's work."""
        written.update(store.write(batch_id, {name: table}))
        return store.at(written[name], table.schema)

    if waiting.count() >= rules.min_batch:
        order = ordered_index(waiting.withColumn("_order", F.struct("publishAt", "id")), "_order", "_at").drop("_order")
        if old["members"] is None:
            start = 0
            members = waiting.limit(0).select(F.lit(None).cast("string").alias("cluster"), F.lit(None).cast("long").alias("pos"), *rows.columns)
            clusters = spark.createDataFrame([], "cluster string, ord long")
        else:
            start = (old["members"].agg(F.max("pos")).first()[0] or 0) + 1
            clusters = retain(old["clusters"], end_ms, rules.single_days, rules.days)
            members = old["members"].join(clusters.select("cluster"), "cluster", "left_semi")
        new = stored(order.withColumn("pos", F.col("_at") + start).drop("_at"))
        found = assign(members, clusters, new).select(
            "id", F.coalesce("cluster", F.col("opened_by").cast("string")).alias("cluster"))
        joined = new.join(found, "id").select("cluster", "pos", *rows.columns)
        members = kept("members", members.select("cluster", "pos", *rows.columns).unionByName(joined))
        clusters = kept("clusters", attributes(members))
        saved = clusters.where(F.col("size") > rules.save_above).withColumn("batch_id", F.lit(batch_id).cast("long"))
        tables |= {"waiting": waiting.limit(0),
                   "log": saved.select("batch_id", "cluster", F.col("size").alias("hot"), "id", "title", "keywords", F.col("publish_time").alias("publishAt")),
                   "log_members": saved.select("batch_id", "cluster").join(members.select("cluster", "id", "pos"), "cluster")}
    written |= store.write(batch_id, tables)
    if before_commit is not None:
        before_commit(batch_id)
    store.commit(batch_id, written)


def run_stream(stream: DataFrame, store: VersionedStore, assign: Assign, rules: LiveRules = LiveRules(), available_now: bool = True,
               before_commit: Callable[[int], None] | None = None):
    """The job over a stream of articles: every batch once, hourly in production, all that is there with ``available_now``."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        run_batch(store, batch_id, batch, assign, rules, before_commit)

    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{store.root}/_progress")
    running = (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")).start()
    if available_now:
        running.awaitTermination()
    return running
