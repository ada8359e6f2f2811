"""Mixing sources to target weights by Poisson replication.

A document of source s is repeated k times, k being the Poisson number with
mean ``rate(s)`` at a uniform number hashed from seed, doc_id and text.  The
copies are exploded and put into a global random order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged, unit_interval

#: A mean above this is drawn as a sum of independent Poisson numbers of equal
#: smaller means, which is the same law and keeps exp(-mean) far from zero.
PIECE = 64.0
ALPHA = 0.7
SEED = 23


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA,
                 total: float | None = None) -> DataFrame:
    """``source, rate``: mean repetitions that bring every source to its share of ``total`` rows.

    ``weights`` are target shares by source (a source without one gets none);
    without weights the shares follow ``rows ** alpha``, which lifts small
    sources.  ``total`` defaults to the present number of rows.
    """
    size = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        share = F.pow(F.col("n").cast("double"), F.lit(alpha))
    else:
        named = F.create_map(*[F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))]) if weights else F.lit(None).cast("map<string,double>")
        share = F.coalesce(named[F.col("source")], F.lit(0.0))
    sized = staged(size.withColumn("share", share), "source_sizes")
    sums = sized.agg(F.sum("share").alias("shares"), F.sum("n").cast("double").alias("rows"))
    goal = F.lit(float(total)) if total is not None else sums.select("rows").scalar()
    return staged(sized.select("source", (F.col("share") * goal / sums.select("shares").scalar() / F.col("n")).alias("rate")), "source_rates")


def poisson(rate: Column, seed: int, *key: Column) -> Column:
    """The Poisson number with mean ``rate`` at the uniform number hashed from ``seed`` and ``key``."""
    pieces = F.greatest(F.lit(1), F.ceil(rate / PIECE)).cast("int")

    def one(i: Column) -> Column:
        u = unit_interval(F.lit(seed), i, *key)
        mean = rate / pieces
        last = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")
        start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.lit(0).alias("k"), u.alias("u"))
        return F.aggregate(
            F.sequence(F.lit(1), last), start,
            lambda a, k: F.struct((a.p * mean / k).alias("p"), (a.c + a.p * mean / k).alias("c"),
                                  F.when(a.c < a.u, k).otherwise(a.k).alias("k"), a.u.alias("u")),
            lambda a: a.k)

    return F.aggregate(F.transform(F.sequence(F.lit(1), pieces), one), F.lit(0), lambda a, b: a + b)


def mix(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA,
        total: float | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` with every row repeated by its Poisson number; adds rate, copies, copy_no, mix_key.

    ``mix_key`` is the random order of the output (ties by copy_no and
    doc_id).  A null source is a source of its own.  Rows equal in doc_id and
    text get the same number.  A source without weight, and an empty table,
    give no rows.  Columns of ``docs`` with these names are replaced.
    """
    added = ("rate", "copies", "copy_no", "mix_key")
    plain = docs.drop(*added)
    rates = source_rates(plain, weights, alpha, total).select(F.col("source").alias("__source"), "rate")
    key = [F.col("doc_id"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))]
    return (plain.join(rates, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
            .withColumn("copies", poisson(F.col("rate"), seed, *key))
            .where("copies > 0")
            .withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .withColumn("mix_key", F.md5(F.concat_ws("|", F.lit(f"order{seed}"), F.coalesce(key[0].cast("string"), F.lit("~")), key[1], F.col("copy_no").cast("string")))))


def shuffled(mixed: DataFrame) -> DataFrame:
    """The global shuffle: range partitions of the random key, sorted inside."""
    return mixed.repartitionByRange("mix_key").sortWithinPartitions("mix_key", "copy_no", "doc_id")


def slots(mixed: DataFrame, block_rows: int = 500_000) -> DataFrame:
    """Adds the gapless global position ``slot`` in the order of (mix_key, doc_id, copy_no).

    Positions are ranked inside blocks of the key and offset by the block
    counts, so no task ranks all rows.
    """
    total = mixed.count()
    digits = max(1, math.ceil(math.log(max(2, total / block_rows), 16)))
    blocked = mixed.withColumn("__b", F.substring("mix_key", 1, digits))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(blocked.groupBy("__b").agg(F.count("*").alias("__n")).select(
        "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")), "mix_blocks")
    inside = F.row_number().over(Window.partitionBy("__b").orderBy("mix_key", "doc_id", "copy_no"))
    return (blocked.withColumn("__i", inside).join(starts, "__b")
            .withColumn("slot", (F.col("__start") + F.col("__i") - 1).cast("long")).drop("__b", "__i", "__start"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed and shuffled documents, with the columns of ``docs`` as they are."""
    # The row travels whole in one column, so that no column of the caller meets one of the operator.
    rows = docs.select("doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    return shuffled(mix(rows).select("doc_id", "mix_key", "copy_no", "__row")).select("__row.*")


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Order of the mixed corpus: one row per copy, by id (the text stays where it is)."""
    keyed = staged(mix(docs.select("doc_id", "source", "text")).select(
        "doc_id", "source", "rate", "copies", "copy_no", "mix_key"), "mix")
    return slots(keyed).select("doc_id", "source", F.round("rate", 9).alias("rate"), "copies", "copy_no", "slot")


SQL = f"""
WITH RECURSIVE size AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
share AS (SELECT source, n, pow(n::DOUBLE, {ALPHA}) AS w FROM size),
rates AS (
  SELECT source, w * (SELECT sum(n)::DOUBLE FROM share) / (SELECT sum(w) FROM share) / n AS rate FROM share
), cdf AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM cdf WHERE k < ceil(rate + 12 * sqrt(rate) + 24)
), d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS h FROM documents
), u AS (
  SELECT *, (('0x' || substr(md5(concat_ws('|', '{SEED}', '1', coalesce(doc_id::VARCHAR, '~'), h)), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u FROM d
), n AS (
  SELECT u.doc_id, u.source, u.h, cdf.rate, count(*) FILTER (WHERE cdf.c < u.u) AS copies
  FROM u JOIN cdf ON u.source IS NOT DISTINCT FROM cdf.source GROUP BY ALL
), e AS (
  SELECT doc_id, source, rate, copies, unnest(range(1, copies + 1)) AS copy_no, h FROM n
)
SELECT doc_id, source, round(rate, 9) AS rate, copies, copy_no,
  row_number() OVER (ORDER BY md5(concat_ws('|', 'order{SEED}', coalesce(doc_id::VARCHAR, '~'), h, copy_no::VARCHAR)), doc_id, copy_no) - 1 AS slot
FROM e
"""
