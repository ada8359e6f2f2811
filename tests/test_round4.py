"""Findings of the fourth round: what is ranked or merged together comes out as if each document were read alone."""
import random

import numpy as np

from tidings.operators import keywords


def rank_alone(tokens, natures, stop, span=5, d=0.85, iterations=10, topk=20):
    """TextRank of one document by dictionaries, one word after the other."""
    ok = [nat in natures and len(w.strip()) >= 2 and w.lower() not in stop for w, nat in tokens]
    counts, graph = {}, {}
    for i in range(len(tokens)):
        for j in range(i + 1, min(i + span, len(tokens))):
            if ok[i] and ok[j]:
                key = (tokens[i][0], tokens[j][0])
                counts[key] = counts.get(key, 0) + 1
    for (a, b), w in counts.items():
        graph.setdefault(a, []).append((b, w))
        graph.setdefault(b, []).append((a, w))
    if not graph:
        return []
    ws = {k: 1.0 / len(graph) for k in graph}
    out = {k: float(sum(w for _, w in e)) for k, e in graph.items()}
    for _ in range(iterations):
        for k in sorted(graph):
            ws[k] = (1 - d) + d * sum(w / out[nb] * ws[nb] for nb, w in graph[k])
    lo, hi = min(ws.values()), max(ws.values())
    return sorted(((k, (v - lo / 10.0) / (hi - lo / 10.0)) for k, v in ws.items()), key=lambda kv: kv[1], reverse=True)[:topk]


def test_textrank_of_many_documents_is_that_of_each(spark):
    rng = random.Random(3)
    names = ["the", " a", "Zoo", "élan", "中国"] + [f"w{i}" for i in range(120)]
    docs = [[(names[min(int(rng.expovariate(0.05)), 124)], rng.choice(["n", "n", "v", "x"])) for _ in range(rng.choice([0, 1, 4, 60, 400]))] for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, seg array<struct<word:string,nature:string>>").coalesce(1)
    got = {}
    for r in df.transform(keywords.textrank, "id", "seg", natures=("n", "v"), stop_words=("the",)).collect():
        got.setdefault(r.id, []).append((r.word, r.weight))
    wanted = {i: rank_alone(x, {"n", "v"}, {"the"}) for i, x in enumerate(docs)}
    assert got == {i: x for i, x in wanted.items() if x}  # bit by bit: ties break as they did


def test_textrank_of_many_tokens_is_not_a_walk(spark):
    import time
    rng = np.random.default_rng(5)
    ids, doc = rng.zipf(1.3, 400_000) % 20_000, np.repeat(np.arange(1000), 400)
    began = time.process_time()
    doc, word, weight = keywords._ranked(doc, ids, rng.permutation(20_000), 5, 0.85, 10, 20)
    assert len(doc) == 20_000 and time.process_time() - began < 15


def test_pairs_of_large_groups_are_read_from_stored_blocks(spark, monkeypatch):
    from tidings.operators import vectors as V
    monkeypatch.setattr(V, "_TILE", 16)
    rng = np.random.default_rng(2)
    m = rng.normal(size=(130, 6)).round(2)
    m[7] = 0
    rows = [(i if i != 50 else 49, None if i == 3 else "large" if i < 90 else f"g{i % 20}", m[i].tolist()) for i in range(130)]
    df = spark.createDataFrame(rows, "id long, g string, v array<double>")
    found = V.similar_pairs(df, "id", "v", 0.6, "g", block=4, also=("n", slice(0, 2)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange hashpartitioning" not in plan  # each block was exchanged for each of its pairs
    unit = lambda x: x / np.linalg.norm(x) if np.linalg.norm(x) else x
    wanted = sorted((rows[i][1], *sorted((rows[i][0], rows[j][0])), round(float(unit(m[i]) @ unit(m[j])), 9), round(float(unit(m[i][:2]) @ unit(m[j][:2])), 9))
                    for i in range(130) for j in range(i) if rows[i][1] and rows[i][1] == rows[j][1] and unit(m[i]) @ unit(m[j]) >= 0.6)
    assert sorted((r.g, r.a, r.b, round(r.cos, 9), round(r.n, 9)) for r in found.collect()) == wanted


def test_cooccurring_words_are_counted_where_the_document_lies(spark, monkeypatch):
    from tidings.operators import features as FE
    monkeypatch.setattr(FE, "_TOKENS_AT_ONCE", 40)
    rng = random.Random(4)
    docs = [(None if i in (3, 9) else i // 2, [(rng.choice(["aa", "bb", "the", "c", "dd"]), rng.choice("nx")) for _ in range(rng.choice([0, 1, 9, 30]))]) for i in range(60)]
    df = spark.createDataFrame([*docs, (77, None)], "id int, seg array<struct<word:string,nature:string>>")
    found = FE.cooccur_edges(df, "id", "seg", natures=("n",), stop_words=("the",), span=3)
    assert found._jdf.queryExecution().sparkPlan().toString().count("Exchange") == 1  # documents; pairs were exchanged one by one
    wanted = {}
    for i, toks in docs:
        fits = [nat == "n" and w not in ("the", "c") for w, nat in toks]
        for x in range(len(toks)):
            for y in range(x + 1, min(x + 3, len(toks))):
                if fits[x] and fits[y]:
                    key = (i, toks[x][0], toks[y][0])
                    wanted[key] = wanted.get(key, 0) + 1
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(wanted) and {r[:3]: r[3] for r in rows} == wanted


def test_chunk_tokens_of_documents_exchange_texts_only(spark, tmp_path):
    from tidings.plans import catalog_annotate as CA
    texts = [(1, "say (big cat) now.Plain one"), (2, "a《b c》\n."), (None, "lost"), (3, None), (4, "é(x"), (5, "ab (c)"), (5, "ab (c)")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = CA.chunk_token_merge_q(spark, str(tmp_path))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and "Window" not in plan and plan.count("Exchange") <= 1  # tokens were exchanged three times
    got = {}
    for r in found.collect():
        got.setdefault((r.doc_id, r.s_idx), []).append((r.k, r.word, r.nature, r.offset))
    assert [x[1:] for x in sorted(got[1, 0])] == [("say", "n", 0), (" ", "w", 3), ("(big cat)", "n", 4), (" ", "w", 13), ("now", "n", 14)]
    assert [x[1:] for x in sorted(got[1, 1])] == [("Plain", "n", 0), (" ", "w", 5), ("one", "n", 6)]
    assert [x[1:] for x in sorted(got[2, 0])] == [("a", "n", 0), ("《b c》", "n", 1), ("\n", "w", 6)]
    assert [x[1] for x in sorted(got[4, 0])] == ["é", "(", "x"]
    assert {k[0] for k in got} == {1, 2, 4, 5}


def test_roles_meet_the_words_of_their_sentence_as_one_row(spark):
    from tidings.operators import annotate as A
    sents = spark.createDataFrame([(1, ["we", "saw", "big", None, "cats"], list("nvnnn"), [(0, "HED")] * 5), (2, ["x"], None, None), (None, ["y"], ["v"], [(0, "HED")]),
                                   (3, ["go", "on"], ["v", "n"], [(0, "HED")] * 2), (3, ["go", "up"], ["v", "n"], [(0, "HED")] * 2)],
                                  "id int, words array<string>, postags array<string>, arcs array<struct<head:int,rel:string>>")
    roles = spark.createDataFrame([(1, 1, "A0", -4, 0), (1, 1, "A1", 2, 99), (1, 1, "TMP", 3, 3), (1, 3, "A1", 4, 2), (1, 7, "A0", 0, 0), (2, 0, "A0", 0, 0),
                                   (None, 0, "A0", 0, 0), (3, 0, "A1", 1, None), (3, None, "A0", 0, 0), (9, 0, "A0", 0, 0)],
                                  "id int, pred int, role string, start int, end int")
    found = A.role_triples(roles, sents, ["id"])
    assert "generate" not in found._jdf.queryExecution().logical().toString().lower().replace("generate explode(x", "")  # words are not exploded to be joined
    assert sorted(map(tuple, found.collect()), key=str) == [
        (1, 1, "we", "saw", "bigcats", "", None), (1, 3, "", None, "", None, None), (3, 0, "", "go", "onup", None, None), (3, 0, "", "go", "onup", None, None)]


def test_pairs_need_vectors_of_one_length(spark):
    import pytest
    from tidings.operators import vectors as V
    df = spark.createDataFrame([(1, "g", [1.0, 0.0]), (2, "g", None)], "id long, g string, v array<double>")
    with pytest.raises(Exception, match="without values"):
        V.similar_pairs(df, "id", "v", 0.5, "g").collect()
