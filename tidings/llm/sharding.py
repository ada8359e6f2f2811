"""Uniform sharding by a hypergeometric communication matrix (DataFrame and SQL functions only).

1. Every row gets a partition label from a hash of its columns; the labels are
   counted (one number per label).
2. The matrix "rows of partition p that go to shard s" is drawn exactly as a
   uniform shuffle would fill it: the partitions are halved level by level, and
   the rows that the left half takes from each shard follow the multivariate
   hypergeometric law (a chain of hypergeometric draws by inversion).
3. Rows are permuted inside their partition and dealt by the matrix row.
4. Rows are permuted again inside their shard; the permutation is spread over
   blocks of a random key, so a shard of any size has no single sorting task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

BLOCK_ROWS = 500_000
#: Steps around the mean that a draw looks at: beyond 12 standard deviations
#: and 12 steps the mass is below the resolution of a double.
REACH = 12

# w(k) is proportional to the probability of k; x holds good, bad, n, u and the range a..b.
_RATIO = "acc.w * ((x.good - k + 1D) * (x.n - k + 1D)) / (k * (x.bad - x.n + CAST(k AS DOUBLE)))"
_STEPS = "IF(x.b > x.a, sequence(x.a + 1L, x.b), CAST(array() AS ARRAY<BIGINT>))"
_TOTAL = (f"aggregate({_STEPS}, named_struct('w', 1D, 's', 0D),"
          f" (acc, k) -> named_struct('w', {_RATIO}, 's', acc.s + acc.w), acc -> acc.s + acc.w)")
_FIND = (f"aggregate({_STEPS}, named_struct('w', 1D, 's', 0D, 'r', x.a),"
         f" (acc, k) -> named_struct('w', {_RATIO}, 's', acc.s + acc.w, 'r', IF(acc.s + acc.w < x.t, k, acc.r)), acc -> acc.r)")


def _bound(name: str, fields: str, body: str) -> str:
    """Bind a struct to ``name`` inside ``body`` (lambda variable, evaluated once)."""
    return f"element_at(transform(array(named_struct({fields})), {name} -> {body}), 1)"


def hypergeometric(good: str, bad: str, n: str, u: str) -> str:
    """SQL for the number of good ones among ``n`` draws without replacement, by inversion at ``u``."""
    mean = "(y.n * CAST(y.good AS DOUBLE) / (y.good + y.bad))"
    spread = ("sqrt(y.n * (CAST(y.good AS DOUBLE) / (y.good + y.bad)) * (CAST(y.bad AS DOUBLE) / (y.good + y.bad))"
              " * (y.good + y.bad - y.n) / greatest(1, y.good + y.bad - 1))")
    same = "'good', {0}.good, 'bad', {0}.bad, 'n', {0}.n, 'u', {0}.u"
    z = _bound("x", same.format("z") + ", 'a', z.a, 'b', z.b, 't', z.u * z.s", _FIND)
    x = _bound("z", same.format("x") + f", 'a', x.a, 'b', x.b, 's', {_TOTAL}", z)
    ranged = _bound("x", same.format("y")
                    + f", 'a', greatest(0L, y.n - y.bad, CAST(floor({mean} - {REACH} * {spread}) AS BIGINT) - {REACH}L)"
                    + f", 'b', least(y.n, y.good, CAST(ceil({mean} + {REACH} * {spread}) AS BIGINT) + {REACH}L)", x)
    drawn = f"CASE WHEN y.good = 0 OR y.n = 0 THEN 0L WHEN y.bad = 0 THEN y.n ELSE {ranged} END"
    return _bound("y", f"'good', {good}, 'bad', {bad}, 'n', {n}, 'u', {u}", drawn)


def _left_share(seed: int) -> str:
    """SQL: how many rows of every shard the left half of a node takes."""
    u = f"((xxhash64({seed}L, lo, size(ns), s) & 4503599627370495L) + 0.5D) / 4503599627370496D"
    k = hypergeometric("caps[s]", "acc.rest - caps[s]", "acc.n", u)
    step = _bound("d", f"'k', {k}", "named_struct('n', acc.n - d.k, 'rest', acc.rest - caps[s], 'out', array_append(acc.out, d.k))")
    left = "aggregate(slice(ns, 1, half), 0L, (t, v) -> t + v)"
    return (f"aggregate(sequence(0, size(caps) - 1), named_struct('n', {left},"
            f" 'rest', aggregate(caps, 0L, (t, v) -> t + v), 'out', CAST(array() AS ARRAY<BIGINT>)), (acc, s) -> {step}, acc -> acc.out)")


def communication_matrix(counts: DataFrame, n_partitions: int, sizes: list[int], seed: int) -> DataFrame:
    """``p, caps``: for every partition the number of its rows that each shard gets.

    ``counts`` is ``p, n``; row sums are its counts and column sums ``sizes``, exactly.
    """
    spark = counts.sparkSession
    every = spark.range(n_partitions).select(F.col("id").cast("int").alias("p")).join(counts, "p", "left")
    node = every.agg(F.expr("transform(array_sort(collect_list(struct(p, coalesce(n, 0L) AS n))), v -> v.n)").alias("ns")).select(
        F.lit(0).alias("lo"), "ns", F.array(*[F.lit(int(v)).cast("long") for v in sizes]).alias("caps"))
    for _ in range(math.ceil(math.log2(n_partitions)) if n_partitions > 1 else 0):
        halved = node.withColumn("half", F.expr("size(ns) - size(ns) div 2"))
        drawn = halved.withColumn("took", F.expr(f"CASE WHEN size(ns) = 1 THEN caps ELSE {_left_share(seed)} END"))
        node = drawn.select(F.explode(F.expr(
            "filter(array(named_struct('lo', lo, 'ns', slice(ns, 1, half), 'caps', took),"
            " named_struct('lo', lo + half, 'ns', slice(ns, half + 1, size(ns)), 'caps', zip_with(caps, took, (c, t) -> c - t))),"
            " v -> size(v.ns) > 0)")).alias("v")).select("v.*")
    return node.select(F.col("lo").alias("p"), "caps")


def shard_rows(df: DataFrame, n_shards: int = 16, seed: int = 17, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 in each shard).

    A uniform shuffle of all rows cut into shards whose counts differ by at
    most one.  Deterministic for given rows and seed.  Rows that are equal in
    every column are interchangeable.  An empty table gives no rows; columns of
    ``df`` named ``shard`` or ``slot`` are replaced.
    """
    payload = [c for c in df.columns if c not in ("shard", "slot")]
    whole = F.struct(*[F.col(f"`{c}`") for c in payload])
    base = staged(df.select(whole.alias("v"), *[F.xxhash64(F.lit(seed + i), whole).alias(k) for i, k in enumerate(("k0", "k1", "k2"))]), "shard_rows")
    total = base.count()
    n_partitions = max(1, math.ceil(total / block_rows), min(total // 1000, 64))
    rows = base.withColumn("p", F.expr(f"CAST(pmod(k0, {n_partitions}) AS INT)"))
    counts = rows.groupBy("p").agg(F.count("*").alias("n"))
    sizes = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    matrix = staged(communication_matrix(counts, n_partitions, sizes, seed).select(
        "p", F.expr("transform(sequence(1, size(caps)), i -> aggregate(slice(caps, 1, i), 0L, (t, v) -> t + v))").alias("ends")), "shard_matrix")
    local = rows.withColumn("r", F.row_number().over(Window.partitionBy("p").orderBy("k1", "k2", "v")) - 1)
    blocks = max(1, math.ceil(total / n_shards / block_rows), min(total // n_shards // 1000, 8))
    dealt = staged(local.join(matrix, "p").select(
        "v", "k2", F.expr("CAST(size(filter(ends, e -> e <= r)) AS INT)").alias("shard"),
        F.expr(f"CAST(shiftrightunsigned(k2, 33) * {blocks} div 2147483648L AS INT)").alias("b")), "shard_dealt")
    before = Window.partitionBy("shard").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(dealt.groupBy("shard", "b").agg(F.count("*").alias("n")).select(
        "shard", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "shard_starts")
    ranked = dealt.withColumn("i", F.row_number().over(Window.partitionBy("shard", "b").orderBy("k2", "v")) - 1)
    return ranked.join(starts, ["shard", "b"]).select(
        *[F.col("v").getField(c).alias(c) for c in payload], "shard", (F.col("start") + F.col("i")).cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order inside range partitions of (shard, slot)."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Shards of all documents by row count; the text stays out of the exchange.

    Size and checksum are functions of the row, so they are taken before it is
    moved.  A null text has size 1 and the checksum of the empty text; null ids
    and repeated rows are dealt like any other row.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    return shard_rows(rows).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                   F.lit(None).cast("int").alias("grown_shard"))
