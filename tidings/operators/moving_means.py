"""Incremental clustering against moving means (C1), exact, in speculative rounds.

Sequential rule: documents come in ``pos`` order; each joins the cluster whose
mean vector has the largest cosine with it (ties: the older cluster) if that
is at least ``threshold``, else it opens a cluster.  A mean moves with every
member.

A round assumes an assignment and decides every document against the cluster
states that the assumption gives at its place in the order.  If the decisions
equal the assumption, they are the sequential result: by induction every
document saw the right states.  Otherwise they are the next assumption; the
documents up to the first one that changed are final, so every round settles
at least one more document, and in practice errors die out in some ten rounds.

A cluster's states are running sums of its members.  They are cut into packets
of consecutive states, growing with the cluster; a packet has an anchor (its
last state) and a drift, the largest angle between the anchor and one of its
states (a mean of n members moves little with one more).  Documents meet
anchors by matrix products of bounded blocks; only where the angle minus the
drift can reach the threshold is the exact state looked at.

Running sums are built in two levels, inside time slices and over the slices
of a cluster, so that a cluster with a third of all documents is no single
task's work.  Every round's state is a reliable checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, stored

SLICE_ROWS = 1024
PACKET_STATES = 64
#: Bytes of the vectors of one side of a block product.
BLOCK_BYTES = 16 << 20


def ordered_index(df: DataFrame, order_col: str, name: str = "idx") -> DataFrame:
    """``df`` with its gapless place in the order of ``order_col`` (range partitions, offset by their counts)."""
    parts = stored(df.repartitionByRange(order_col).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(order_col))
    return (parts.withColumn("_row", inside).join(starts, "_part")
            .withColumn(name, (F.col("_start") + F.col("_row") - 1).cast("long")).drop("_part", "_row", "_start"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of float64 from binaries of equal length."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1) if rows else np.zeros((0, 0))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """array<double> to bytes."""
    for batch in batches:
        v = [np.asarray(x, "<f8").tobytes() for x in batch.column("v").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("idx"), pa.array(v, pa.binary())], ["idx", "v"])


def _slice_sums(members: pa.Table) -> pa.Table:
    """The members of one cluster in one time slice: their places and running sums."""
    order = np.argsort(members.column("idx").to_numpy())
    v = _matrix(members.column("v"))[order]
    idx = members.column("idx").to_numpy()[order]
    return pa.table({"key": members.column("key").slice(0, 1), "slice": members.column("slice").slice(0, 1), "places": pa.array([idx], pa.list_(pa.int64())),
                     "sums": pa.array([np.cumsum(v, axis=0).astype("<f8").tobytes()], pa.binary()),
                     "total": pa.array([v.sum(0).astype("<f8").tobytes()], pa.binary())})


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over slices sorted by cluster: what came before each slice, and where the next one begins."""
    names = ["p_key", "p_slice", "base", "n_before", "until"]
    last, row, total, n = None, None, None, 0

    def out(rows):
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()),
                                           pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())], names)

    for batch in batches:
        rows = []
        for key, part, first, count, add in zip(*(batch.column(c).to_pylist() for c in ("key", "slice", "first", "n", "total"))):
            add = np.frombuffer(add, "<f8")
            if key != last:
                if row is not None:
                    rows.append((*row, None))
                total, n = np.zeros(len(add)), 0
            elif row is not None:
                rows.append((*row, first))
            row = (key, part, total.astype("<f8").tobytes(), n)
            total, n, last = total + add, n + count, key
        if rows:
            yield out(rows)
    if row is not None:
        yield out([(*row, None)])


def _packets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packets of states: valid for documents after ``places[0]`` up to ``until``."""
    for batch in batches:
        for r in batch.to_pylist():
            places = r["places"]
            base = np.frombuffer(r["base"], "<f8")
            states = base + np.frombuffer(r["sums"], "<f8").reshape(len(places), -1)
            keys, spots, untils, data = [], [], [], []
            at, n = 0, r["n_before"]
            while at < len(places):
                size = min(len(places) - at, PACKET_STATES, max(1, (n + at) // 4))
                end = at + size
                keys.append(r["key"])
                spots.append(places[at:end])
                untils.append(places[end] if end < len(places) else r["until"])
                data.append(states[at:end].astype("<f8").tobytes())
                at = end
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(spots, pa.list_(pa.int64())), pa.array(untils, pa.int64()),
                                              pa.array(data, pa.binary())], ["key", "places", "until", "states"])


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def best_states(idx: np.ndarray, v: np.ndarray, keys: np.ndarray, places: list[np.ndarray], until: np.ndarray, states: np.ndarray, threshold: float):
    """(idx, key, score) of the best state of every document that reaches the threshold, at its place in the order."""
    sizes = np.array([len(p) for p in places])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(keys)), sizes)
    unit, docs = _unit(states), _unit(v)
    anchor = unit[ends - 1]
    drift = np.zeros(len(keys))
    np.maximum.at(drift, owner, np.arccos(np.clip(np.einsum("ij,ij->i", unit, anchor[owner]), -1, 1)))
    spots = np.concatenate(places)
    first = spots[ends - sizes]
    # The least cosine with the anchor at which a state of the packet can reach the threshold.
    least = np.cos(np.minimum(np.arccos(np.clip(threshold, -1, 1)) + drift, np.pi)) - 1e-9
    span = int(max(spots.max(), idx.max())) + 3
    found = []
    step = max(1, (4 << 20) // max(1, len(keys)))
    for at in range(0, len(idx), step):
        here = idx[at:at + step]
        close = docs[at:at + step] @ anchor.T >= least
        close &= (here[:, None] > first) & (here[:, None] <= until)
        i, e = np.nonzero(close)
        if not len(i):
            continue
        # The last state whose member comes before the document.
        row = np.searchsorted(owner * span + spots + 1, e * span + here[i] + 1, "left") - 1
        score = np.concatenate([np.einsum("ij,ij->i", docs[at + i[u:u + 65536]], unit[row[u:u + 65536]]) for u in range(0, len(i), 65536)])
        good = score >= threshold
        i, key, score = i[good], keys[e[good]], score[good]
        if len(i):
            order = np.lexsort((key, -score, i))
            lead = order[np.concatenate([[True], np.diff(i[order]) > 0])]
            found.append((here[i[lead]], key[lead], score[lead]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*found))


def _cell(threshold: float):
    def run(docs: pa.Table, packets: pa.Table) -> pa.Table:
        names = ["idx", "key", "score"]
        if not docs.num_rows or not packets.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        idx, v = docs.column("idx").to_numpy(), _matrix(docs.column("v"))
        until = packets.column("until").fill_null(np.iinfo(np.int64).max).to_numpy()
        states = np.frombuffer(b"".join(packets.column("states").to_pylist()), "<f8").reshape(-1, v.shape[1])
        places = [np.asarray(p, np.int64) for p in packets.column("places").to_pylist()]
        out = best_states(idx, v, packets.column("key").to_numpy(), places, until, states, threshold)
        return pa.table([pa.array(x) for x in out], names=names)
    return run


def _states(docs: DataFrame, assigned: DataFrame, base: DataFrame) -> DataFrame:
    """Packets of all clusters' states under an assignment; ``base`` are retained sums as members before the first document."""
    opened = assigned.where(F.col("key") == F.col("idx")).select(F.col("key").alias("open_key"))
    kept = assigned.where("key < 0").unionByName(
        assigned.where("key >= 0").join(opened, F.col("key") == F.col("open_key"), "left_semi"))
    members = docs.join(kept, "idx").select("key", (F.col("idx") / SLICE_ROWS).cast("long").alias("slice"), "idx", "v").unionByName(base)
    slices = cut_lineage(members.groupBy("key", "slice").applyInArrow(
        _slice_sums, "key long, slice long, places array<long>, sums binary, total binary"))
    running = (slices.select("key", "slice", F.col("places")[0].alias("first"), F.size("places").cast("long").alias("n"), "total")
               .repartition("key").sortWithinPartitions("key", "slice")
               .mapInArrow(_running, "p_key long, p_slice long, base binary, n_before long, until long"))
    joined = slices.drop("total").join(running, (F.col("key") == F.col("p_key")) & (F.col("slice") == F.col("p_slice")))
    return joined.select("key", "places", "sums", "base", "n_before", "until").mapInArrow(
        _packets, "key long, places array<long>, until long, states binary")


def moving_mean_clusters(vectors: DataFrame, retained: DataFrame | None, id_col: str, pos_col: str, vec_col: str,
                         threshold: float = 0.7, block_bytes: int = BLOCK_BYTES, rounds: list[int] | None = None) -> DataFrame:
    """(id, cluster, opened_by, score): the sequential clustering of ``vectors`` in ``pos`` order (pos unique).

    ``retained`` (cluster, ord, total array<double>) holds the clusters kept
    from earlier runs by the sum of their member vectors, older ones first; it
    may be None or empty.  ``cluster`` is a retained cluster's name, or null
    where ``opened_by`` names the document that opened it; ``score`` is the
    cosine at joining (null for the opener).  Zero vectors open clusters that
    nobody joins.  ``rounds`` collects how many documents changed per round.
    """
    spark = vectors.sparkSession
    named = ordered_index(vectors.select(F.col(id_col).alias("id"), F.col(pos_col).alias("pos"), F.col(vec_col).cast("array<double>").alias("v")), "pos")
    docs = cut_lineage(named.select("idx", "v").mapInArrow(_pack, "idx long, v binary"))
    names = cut_lineage(named.select("idx", "id"))
    size, width = docs.agg(F.count("*"), F.max(F.octet_length("v"))).first()
    if retained is None:
        retained = spark.createDataFrame([], "cluster string, ord long, total array<double>")
    last = retained.agg(F.max("ord")).scalar()
    kept = cut_lineage(retained.select("cluster", (F.col("ord") - last - 1).cast("long").alias("key"), F.col("total").cast("array<double>").alias("v")))
    base = kept.select(F.col("key").alias("idx"), "v").mapInArrow(_pack, "idx long, v binary").select(
        F.col("idx").alias("key"), F.lit(-1).cast("long").alias("slice"), F.lit(-1).cast("long").alias("idx"), "v")
    per_block = max(1, block_bytes // max(8, width or 8))
    doc_blocks = -(-(size or 0) // per_block)
    assigned = cut_lineage(docs.select("idx", F.col("idx").alias("key"), F.lit(None).cast("double").alias("score")))
    settled = -1
    while size:
        packets = cut_lineage(_states(docs, assigned.select("idx", "key"), base))
        held = packets.agg(F.sum(F.size("places"))).first()[0] or 0
        packet_blocks = max(1, -(-held // per_block))
        first_open = (settled + 1) // per_block
        # A cell is a block of documents in the order and a block of packets that some of them can meet.
        left = (docs.where(F.col("idx") > settled).withColumn("row", (F.col("idx") / per_block).cast("long"))
                .withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(packet_blocks - 1)))))
        right = (packets.withColumn("column", F.pmod(F.xxhash64("key", F.col("places")[0]), F.lit(packet_blocks)).cast("int"))
                 .withColumn("from_row", F.greatest(F.lit(first_open), F.floor((F.col("places")[0] + 1) / per_block)).cast("long"))
                 .withColumn("to_row", F.least(F.lit(doc_blocks - 1), F.floor(F.coalesce(F.col("until"), F.lit(size)) / per_block)).cast("long"))
                 .where("from_row <= to_row")
                 .select("key", "places", "until", "states", F.col("column").alias("p_column"), F.explode(F.sequence("from_row", "to_row")).alias("p_row")))
        scored = left.groupBy("row", "column").cogroup(right.groupBy("p_row", "p_column")).applyInArrow(_cell(threshold), "idx long, key long, score double")
        best = scored.groupBy("idx").agg(F.min_by(F.struct("key", "score"), F.struct(-F.col("score"), F.col("key"))).alias("b"))
        decided = (assigned.where(F.col("idx") > settled).select("idx", F.col("key").alias("was")).join(best, "idx", "left")
                   .select("idx", F.coalesce("b.key", "idx").alias("key"), F.col("b.score").alias("score"), "was"))
        decided = cut_lineage(decided)
        changed, first = decided.where("key != was").agg(F.count("*"), F.min("idx")).first()
        assigned = cut_lineage(assigned.where(F.col("idx") <= settled).unionByName(decided.drop("was")))
        if rounds is not None:
            rounds.append(changed)
        if not changed:
            break
        settled = first
    openers = names.select(F.col("idx").alias("key"), F.col("id").alias("opened_by"))
    return (assigned.join(names, "idx").join(kept.select("key", "cluster"), "key", "left").join(openers, "key", "left")
            .select("id", "cluster", "opened_by", "score"))
