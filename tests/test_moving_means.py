"""C1 with moving means: the parallel rounds against the sequential fold."""
import numpy as np
import pytest

from tidings.operators import moving_means


def sequential(vectors, retained, threshold):
    """Every document in order against the current means."""
    sums, names, out = [np.array(t, float) for _, t in retained], [(c, None) for c, _ in retained], []
    for i, v in vectors:
        v = np.array(v, float)
        score = -1.0
        if sums:
            m = np.array(sums)
            norm = np.linalg.norm(m, axis=1) * np.linalg.norm(v)
            cos = np.divide(m @ v, norm, out=np.zeros(len(m)), where=norm > 0)
            k = int(np.argmax(cos))
            score = cos[k]
        if score >= threshold:
            sums[k] = sums[k] + v
            out.append((i, *names[k]))
        else:
            sums.append(v)
            names.append((None, i))
            out.append((i, None, i))
    return out


def batch(seed, n, d, noise, centres, retained, zipf=False):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(centres, d))
    centre /= np.linalg.norm(centre, axis=1)[:, None]
    pick = np.minimum(rng.zipf(1.6, n) - 1, centres - 1) if zipf else rng.integers(0, centres, n)
    v = (centre[pick] + noise * rng.normal(size=(n, d))) * rng.uniform(0.2, 3, (n, 1))
    ids = rng.permutation(n) + 1000
    old = [(f"old{k}", (centre[k] * 5).tolist()) for k in range(retained)]
    return [(int(i), x.tolist()) for i, x in zip(ids, v)], old


CASES = [(2, 250, 20, 0.25, 40, 6, False), (3, 300, 8, 0.3, 30, 3, True)]


@pytest.mark.parametrize("seed, n, d, noise, centres, kept, zipf", CASES)
def test_equals_sequential_fold(spark, monkeypatch, seed, n, d, noise, centres, kept, zipf):
    """Hot clusters over several slices, small packets and blocks, retained and new clusters."""
    monkeypatch.setattr(moving_means, "SLICE_ROWS", 37)
    monkeypatch.setattr(moving_means, "PACKET_STATES", 5)
    rows, old = batch(seed, n, d, noise, centres, kept, zipf)
    docs = spark.createDataFrame([(i, p * 3 + 5, v) for p, (i, v) in enumerate(rows)], "id long, pos long, vec array<double>").repartition(5)
    retained = spark.createDataFrame([(c, k, t) for k, (c, t) in enumerate(old)], "cluster string, ord long, total array<double>")
    rounds = []
    got = moving_means.moving_mean_clusters(docs, retained, "id", "pos", "vec", 0.7, block_bytes=8 * d * 64, rounds=rounds).collect()
    want = sequential(rows, old, 0.7)
    assert sorted((r.id, r.cluster, r.opened_by) for r in got) == sorted(want)
    assert rounds[-1] == 0 and len(rounds) < n / 4
    assert all((r.score is None) == (r.opened_by == r.id) for r in got)


def test_edge_vectors_and_no_rows(spark):
    """Zero vectors lead alone, equal ones join, ties go to the older cluster; no documents, no rows."""
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0]), (5, [0.0, 2.0]), (6, [1.0, 1.0]), (7, [-1.0, 0.0])]
    old = [("a", [0.0, 0.0]), ("b", [0.0, 1.0])]
    docs = spark.createDataFrame([(i, i, v) for i, v in rows], "id long, pos long, vec array<double>")
    retained = spark.createDataFrame([(c, k, t) for k, (c, t) in enumerate(old)], "cluster string, ord long, total array<double>")
    got = moving_means.moving_mean_clusters(docs, retained, "id", "pos", "vec", 0.7).collect()
    assert sorted((r.id, r.cluster, r.opened_by) for r in got) == sorted(sequential(rows, old, 0.7))
    assert moving_means.moving_mean_clusters(docs.limit(0), retained, "id", "pos", "vec").count() == 0
    alone = moving_means.moving_mean_clusters(docs, None, "id", "pos", "vec").collect()
    assert sorted((r.id, r.cluster, r.opened_by) for r in alone) == sorted(sequential(rows, [], 0.7))


def test_ordered_index(spark):
    df = spark.range(1000).selectExpr("pmod(id * 7919, 100003) AS pos", "id").repartition(7)
    rows = moving_means.ordered_index(df, "pos").collect()
    assert [r.idx for r in sorted(rows, key=lambda r: r.pos)] == list(range(1000))
