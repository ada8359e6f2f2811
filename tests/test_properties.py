"""Property tests: partitioning invariance, partition of events into clusters,
delta ∪ snapshot = window, and streaming = batch on the same input."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tidings.operators import events as EV
from tidings.sources import scan

SCHEMA = "cluster_id string, pos long, sub string, verb string, obj string, sentence string, tmp_ms long, rpt_ms long, ners string, core boolean"


def random_events(seed, n=80):
    rnd = random.Random(seed)
    words = ["甲乙", "乙丙", "丙", "甲", "丁戊", "", "甲丁"]
    return [(rnd.choice("ab"), i + 1, rnd.choice(words), rnd.choice(words[:-1]), rnd.choice(words), "s", None, None, "", True)
            for i in range(n)]


@settings(max_examples=3, deadline=None)
@given(st.integers(min_value=0, max_value=10_000))
def test_merge_is_partitioning_invariant_and_a_partition(spark, seed):
    rows = random_events(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    a = {(r.cluster_id, r.pos): r.leader for r in EV.event_merge(df.repartition(1)).collect()}
    b = {(r.cluster_id, r.pos): r.leader for r in EV.event_merge(df.repartition(7)).collect()}
    assert a == b
    assert len(a) == len(rows)                       # every event exactly once
    leaders = {(c, l) for (c, _), l in a.items()}
    assert all(a[(c, l)] == l for c, l in leaders)   # a leader leads itself


def test_delta_union_snapshot_is_window(spark):
    w = spark.createDataFrame([(i,) for i in range(20)], "id long")
    snap = spark.createDataFrame([(i,) for i in range(10, 30)], "id long")
    d = {r.id for r in scan.delta(w, snap).collect()}
    kept = {r.id for r in w.join(snap, "id", "left_semi").collect()}
    assert d | kept == set(range(20)) and not (d & kept)


def test_stream_equals_batch(spark):
    import __spark_entry__ as E
    qs = E.queries()
    sf = "/root/testdata/sf0.001"
    stream = sorted(tuple(r) for r in qs["stream_windows"](spark, sf).collect())
    batch = sorted(tuple(r) for r in qs["slot_counts"](spark, sf).collect())
    assert stream == batch
    ids = {r.id for r in qs["stream_dedup"](spark, sf).collect()}
    assert ids == {r.event_id for r in spark.read.parquet(f"{sf}/events.parquet").collect()}
