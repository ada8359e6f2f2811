import collections

import numpy as np
from llm_cases import DOCS, sentence

from tidings.llm import collision_ann, exact_dedup, language_ppm, mixing, ngram_join, piece_codec


def test_neighbours_on_the_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    frame = table.toPandas()
    vectors = collision_ann._matrix(frame["embedding"])
    want = collision_ann.brute_force(frame["vec_id"].to_numpy(), vectors)
    got = collections.defaultdict(list)
    for r in collision_ann.query(spark, table).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(want)
    hits = [len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 5 for q in want]
    assert np.mean(hits) >= 0.9
    scores = {(q, v): s for q, w in want.items() for v, s in w}
    for q, rows in got.items():
        assert [s for _, s in rows] == sorted((s for _, s in rows), reverse=True)
        assert all(abs(scores[q, v] - s) < 1e-12 for v, s in rows if (q, v) in scores)


def test_recall_on_more_blocks():
    rng = np.random.default_rng(0)
    vectors = rng.standard_normal((9000, 32))
    hits = []
    parts = np.array_split(rng.permutation(9000), 3)
    blocks = [collision_ann.Block(vectors[p]) for p in parts]
    queries = vectors[::450]
    found = [collections.defaultdict(list) for _ in queries]
    for part, block in zip(parts, blocks):
        for i, rows, score in block.search(queries):
            for r, s in zip(rows, score):
                found[i][int(part[r])] = s
    for i, q in enumerate(queries):
        exact = collision_ann._cosines(q, vectors)
        want = [j for j in np.argsort(-exact) if j != i * 450][:5]
        got = sorted((j for j in found[i] if j != i * 450), key=lambda j: -found[i][j])[:5]
        hits.append(len(set(want) & set(got)) / 5)
    assert np.mean(hits) >= 0.9


def test_edge_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (50, [0.0, 1.0], 1), (1, [2.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (6, [1.0, 0.0], 1),
            (7, [1.0, 0.0], 1), (8, None, 1), (9, [0.0, 0.0], 1), (10, [nan, 1.0], 1), (11, [inf, 1.0], 1), (12, [None, 1.0], 1), (None, [1.0, 1.0], 1), (100, [0.0, 0.0], 1), (7, [1.0, 0.0], 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = collections.defaultdict(list)
    for r in collision_ann.query(spark, table).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, round(r.score, 9)))
    assert set(got) == {0, 50}
    assert got[0] == [(i, i, 1.0) for i in range(1, 6)]
    assert [v for _, v, _ in got[50]] == [0, 1, 2, 3, 4]
    assert collision_ann.query(spark, table.limit(0)).count() == 0
    assert collision_ann.query(spark, table.where("vec_id = 0")).count() == 0


def test_pipeline_against_single_steps(spark, tmp_path):
    import corpus_pipeline
    rows = [(i, sentence(i, 60), "en" if i % 2 else "fr", f"s{i % 3}", 1) for i in range(40)]
    rows += [(100, sentence(4, 60).upper(), "en", "s0", 1), (101, sentence(5, 60) + " more", "en", "s1", 1), (102, None, "en", "s1", 1), (103, "12 34", "en", "s1", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id, r.ids) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "near dedup", "mixing", "piece encoding"]

    known = {r[0]: r for r in rows if r[1] and any(c.isalpha() for c in r[1])}
    newest = {}
    for i, r in known.items():
        newest[r[1].lower()] = max(i, newest.get(r[1].lower(), i))
    kept = {i: known[i] for i in newest.values()}
    components = ngram_join.brute_force({i: r[1] for i, r in kept.items()}, 5, 80, 100)
    kept = [kept[i] for i in sorted({c for _, c in components.values()})]
    left = spark.createDataFrame(kept, DOCS)
    copies = {r.doc_id: r.copies for r in mixing.mix(left).collect()}
    grid = piece_codec.Lattice(piece_codec.MODEL)
    want = sorted((r[0], grid.sp.encode(r[1])) for r in kept for _ in range(copies.get(r[0], 0)))
    assert got == want
    assert exact_dedup.keep_distinct(docs).count() == language_ppm.stage(spark, docs, "").count() - 1 + 2


def test_pipeline_near_stage_thresholds(spark):
    """Pairs that link at 0.8 of five-word shingles, though not at 0.85 of four-word ones."""
    import corpus_pipeline
    rng = np.random.default_rng(8)
    rows = []
    for at in range(0, 60, 2):
        base = [f"w{x}" for x in rng.integers(0, 10**9, 50 if at % 4 else 100)]
        other = base[:25] + ["changed"] + base[26:] if at % 4 else base + [f"x{x}" for x in rng.integers(0, 10**9, 22 if at < 40 else 25)]
        rows += [(at, " ".join(base), "en", "s0", 1), (at + 1, " ".join(other), "en", "s0", 1)]
    texts = {r[0]: r[1] for r in rows}
    want = {c for _, c in ngram_join.brute_force(texts, 5, 80, 100).values()}
    assert 30 < len(want) < 60 and len({c for _, c in ngram_join.brute_force(texts).values()}) == 60
    got = sorted(r.doc_id for r in corpus_pipeline.near(spark, spark.createDataFrame(rows, DOCS), "").collect())
    assert got == sorted(want)


def test_pipeline_on_edge_tables(spark, tmp_path, edge_docs):
    """Empty, all null, one row repeated: defined results, no crash."""
    import corpus_pipeline
    one = spark.createDataFrame([(7, sentence(7, 60), "en", "s1", 1)] * 40 + [(8, sentence(9, 60), "en", "s1", 1)], DOCS)
    for name, docs, most in (("empty", edge_docs.limit(0), 0), ("blank", spark.createDataFrame([(None, None, None, None, None)] * 3, DOCS), 3), ("repeated", one, 41)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        rows = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert len(rows) <= most and {r.doc_id for r in rows} <= {7, 8, None}
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
            assert stage(spark, docs, "").columns == docs.columns, k
    assert corpus_pipeline.exact(spark, one, "").count() == 2 and corpus_pipeline.near(spark, corpus_pipeline.exact(spark, one, ""), "").count() == 2
