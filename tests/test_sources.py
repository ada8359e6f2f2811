"""Progress marks, snapshots and windows."""

import tempfile

from tidings.sources import scan


def test_marks_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="marks-")
    assert scan.read_mark(spark, root, 123) == 123
    scan.write_mark(spark, root, 1, 1000)
    scan.write_mark(spark, root, 2, 2000)
    assert scan.read_mark(spark, root, 123) == 2000


def test_days_ago():
    assert scan.days_ago(10 * 86_400_000, 1.5) == int(8.5 * 86_400_000)


def test_delta_first_run_returns_window(spark):
    w = spark.createDataFrame([(1,), (2,)], "id long")
    assert scan.delta(w, None).count() == 2
    snap = spark.createDataFrame([(1,)], "id long")
    assert [r.id for r in scan.delta(w, snap).collect()] == [2]
