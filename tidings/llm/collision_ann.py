"""Approximate nearest neighbours by collision counting (query-aware hashing).

Vectors are normalised and dealt into blocks by a hash.  A block projects its
vectors on ``PROJECTIONS`` random lines and sorts each projection.  Around a
query's own projections, windows are widened step by step (virtual rehashing:
the same sorted arrays serve every radius); a vector in the windows of at least
``THRESHOLD`` lines is verified exactly.  A query stops in a block when enough
vectors have been verified, or when the windows hold the whole block.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

NEIGHBOURS = 5
PROJECTIONS = 48
#: Lines whose window must hold a vector before it is verified.
THRESHOLD = 28
#: A query ends in a block once so many vectors, and this share of it, are verified.
LEAST, SHARE = 250, 0.3
#: Half width of the first window (a unit vector's projections have variance 1), and the factor of each step.
FIRST, FACTOR = 0.8, 1.12
BLOCK = 16_384
QUERY_BLOCK = 4096
SEED = 97


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, v (doubles) of the vectors that take part: not null, not zero, all components finite."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def _matrix(rows) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in rows])


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(1, keepdims=True)
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def _cosines(query: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Cosine on the original vectors; each row is summed alone, so equal vectors give equal values."""
    return (found * query).sum(1) / (np.sqrt((found * found).sum(1)) * math.sqrt(float((query * query).sum())))


class Block:
    """Sorted projections of the vectors of one block."""

    def __init__(self, vectors: np.ndarray, projections: int = PROJECTIONS, threshold: int = THRESHOLD):
        self.vectors, self.size, self.threshold = vectors, len(vectors), threshold
        self.lines = np.random.default_rng(SEED).standard_normal((vectors.shape[1], projections))
        at = _unit(vectors) @ self.lines
        order = np.argsort(at, axis=0, kind="stable")
        self.sorted = np.take_along_axis(at, order, 0)
        self.order = [np.ascontiguousarray(order[:, j]) for j in range(projections)]

    def candidates(self, places: np.ndarray, enough: int):
        """(query row, block rows) of the vectors that collide with a query on enough lines."""
        n, m = self.sorted.shape
        hits = np.zeros((len(places), n), np.uint16)
        low = np.column_stack([np.searchsorted(self.sorted[:, j], places[:, j]) for j in range(m)])
        high, radius, open_ = low.copy(), FIRST, np.arange(len(places))
        while len(open_):
            a = np.column_stack([np.searchsorted(self.sorted[:, j], places[open_, j] - radius) for j in range(m)])
            b = np.column_stack([np.searchsorted(self.sorted[:, j], places[open_, j] + radius, "right") for j in range(m)])
            still = []
            for i, q in enumerate(open_):
                row = hits[q]
                for order, x, y, lo, hi in zip(self.order, a[i], b[i], low[q], high[q]):
                    row[order[x:lo]] += 1  # the ids of one line are distinct
                    row[order[hi:y]] += 1
                low[q], high[q] = a[i], b[i]
                found = np.flatnonzero(row >= self.threshold)
                if len(found) >= enough or (b[i] - a[i] == n).all():
                    yield q, found
                else:
                    still.append(q)
            open_, radius = np.array(still, int), radius * FACTOR

    def search(self, queries: np.ndarray):
        """(query row, block rows, their cosines) of all verified vectors of every query."""
        enough = max(LEAST, int(SHARE * self.size))
        places = _unit(queries) @ self.lines
        for at in range(0, len(queries), 64):
            for q, found in self.candidates(places[at:at + 64], enough):
                yield at + q, found, _cosines(queries[at + q], self.vectors[found])


def _search(k: int):
    def run(key, block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(block) and len(asked):
            queries = _matrix(asked["v"])
            ids = block["ids"].to_list()
            for i, found, score in Block(_matrix(block["v"])).search(queries):
                own = asked["vec_id"].iloc[i]
                # The query's own vector may be one of them, so k + 1 of the scores (and their ties) are enough.
                best = np.flatnonzero(score >= np.partition(score, -(k + 1))[-(k + 1)]) if len(score) > k + 1 else range(len(score))
                # Copies of a vector stand together in ``ids``, smallest first: k + 1 of them always suffice.
                rows = [(-score[f], x) for f in best for x in ids[found[f]] if x != own]
                for s, x in sorted(rows)[:k]:
                    out["query_id"].append(own), out["vec_id"].append(x), out["score"].append(-s)
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of ``vectors`` found for each query.

    Both tables are ``vec_id, v`` as ``usable`` gives them, of one dimension.
    Nearest by cosine, ties to the smaller vec_id; a query is not its own
    neighbour (a row that repeats its id is not either).  Equal vectors are
    indexed once with their k + 1 smallest ids, more can never be among the
    k nearest.  Fewer than k candidates are all returned; no queries or no
    vectors give no rows.
    """
    copies = Window.partitionBy("h", "v").orderBy("vec_id")
    kept = (vectors.distinct().withColumn("h", F.xxhash64("v"))
            .withColumn("r", F.row_number().over(copies)).where(F.col("r") <= k + 1))
    single = staged(kept.groupBy("h", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann_vectors")
    n_blocks = max(1, math.ceil(single.count() / block))
    asked = staged(queries.distinct(), "ann_queries")
    n_parts = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    blocks = single.withColumn("b", F.expr(f"CAST(pmod(shiftright(h, 7), {n_blocks}) AS INT)"))
    # Every block of the query set meets every block of the vectors; the queries are sent, not the vectors.
    parts = (asked.withColumn("p", F.expr(f"CAST(pmod(xxhash64(vec_id), {n_parts}) AS INT)"))
             .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))))
    spread = blocks.withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    found = spread.select("b", "p", "v", "ids").groupBy("b", "p").cogroup(parts.select("b", "p", "v", "vec_id").groupBy("b", "p")).applyInPandas(
        _search(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    rows = staged(usable(embeddings), "ann_usable")
    return nearest(rows, rows.where(F.col("vec_id") % 50 == 0))


def brute_force(ids: np.ndarray, vectors: np.ndarray, k: int = NEIGHBOURS) -> dict:
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        s = _cosines(vectors[i], vectors)
        rows = sorted((-x, j) for x, j in zip(s, ids) if j != ids[i])[:k]
        out[int(ids[i])] = [(int(j), -x) for x, j in rows]
    return out


def probe(spark, sf, rows):
    pdf = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    want = brute_force(pdf["vec_id"].to_numpy(), _matrix(pdf["embedding"]))
    got = {}
    for q, r, v, s in rows:
        got.setdefault(q, set()).add(v)
    print("recall", np.mean([len(got.get(q, set()) & {j for j, _ in w}) / len(w) for q, w in want.items()]), len(want))
