"""C10 with changing keywords: the rounds against the sequential fold."""
import numpy as np
import pytest

from tidings.config import MERGE_RULES
from tidings.operators.merge_fold import merge_fold

SCHEMA = "cluster_id string, id long, size long, order long, keywords array<string>, content_keywords array<string>"


def matches(i, keywords, content):
    t, c = len(set(i["keywords"])), len(set(i["content"]))
    title, cont = len(set(i["keywords"]) & set(keywords)), len(set(i["content"]) & set(content))
    return any((ft is None or title >= int(ft * t + 1e-9)) and (fc is None or cont >= int(fc * c + 1e-9)) for ft, fc in MERGE_RULES)


def counted(lists):
    """Words by falling count, ties by first appearance."""
    counts = {}
    for words in lists:
        for w in words:
            counts[w] = counts.get(w, 0) + 1
    return [w for w, _ in sorted(counts.items(), key=lambda x: -x[1])][:5]


def sequential(clusters, status):
    """One cluster after the other: {name: (target, final id, keywords, swap, freed id)}."""
    accepted, out = [], {}
    for c in clusters:
        c = dict(c, titles=list(c["titles"]), joined=[])
        out[c["name"]] = [c, False, None]
        if c["size"] > 3:
            for j in accepted:
                if j["size"] > 3 and matches(c, j["keywords"], j["content"]):
                    pair = (status.get(c["id"]), status.get(j["id"]))
                    if pair == ("1", "1"):
                        break
                    out[c["name"]][2] = str(c["id"])
                    if pair == ("1", "0"):
                        out[c["name"]][1:] = [True, str(j["id"])]
                        j["id"] = c["id"]
                    j["keywords"] = counted(c["titles"] + j["titles"])
                    j["titles"] += c["titles"]
                    j["size"] += c["size"]
                    out[c["name"]][0] = j
                    break
            if out[c["name"]][0] is c:
                accepted.append(c)
    return {name: (t["name"], str(t["id"]), t["keywords"], swap, freed) for name, (t, swap, freed) in out.items()}


def batch(seed, n, vocabulary, short):
    rng = np.random.default_rng(seed)
    clusters = []
    for i in range(n):
        topic = int(rng.integers(0, 6))
        pick = lambda m: [f"w{(topic * 5 + int(x)) % vocabulary}" for x in rng.zipf(1.7, m) % 11]
        titles = [pick(int(rng.integers(1, 6))) for _ in range(int(rng.integers(1, 4)))]
        content = list(dict.fromkeys(f"c{(topic * 4 + int(x)) % vocabulary}" for x in rng.integers(0, 9, 7)))[:1 if short and i % 9 == 4 else 5]
        clusters.append({"name": f"k{i}", "id": 100 + i, "size": int(rng.integers(2, 9)), "titles": titles, "keywords": counted(titles), "content": content})
    status = {c["id"]: str(int(rng.integers(0, 2))) for c in clusters if rng.random() < 0.5}
    return clusters, status


@pytest.mark.parametrize("seed, n, vocabulary, short, editors", [(1, 120, 40, False, False), (2, 150, 30, True, True)])
def test_equals_sequential_fold(spark, seed, n, vocabulary, short, editors):
    clusters, status = batch(seed, n, vocabulary, short)
    if not editors:
        status = {}
    table = spark.createDataFrame([(c["name"], c["id"], c["size"], i, c["keywords"], c["content"]) for i, c in enumerate(clusters)], SCHEMA)
    words = []
    for c in clusters:
        flat = [w for t in c["titles"] for w in t]
        words += [(c["name"], w, flat.count(w), flat.index(w)) for w in dict.fromkeys(flat)]
    words = spark.createDataFrame(words, "cluster_id string, word string, cnt long, first long")
    marks = spark.createDataFrame(list(status.items()), "id long, status string") if editors else None
    rounds = []
    got = merge_fold(table, words, marks, rounds=rounds).collect()
    want = sequential(clusters, status)
    assert {r.cluster_id: (r.target, r.final_id, r.keywords, r.swap, r.dropped_id) for r in got} == want
    assert rounds[-1] == 0 and sum(r.merged for r in got) == sum(k != v[0] for k, v in want.items()) > n / 4


def test_no_clusters_and_small_ones(spark):
    empty = spark.createDataFrame([], SCHEMA)
    words = spark.createDataFrame([], "cluster_id string, word string, cnt long, first long")
    assert merge_fold(empty, words).count() == 0
    small = spark.createDataFrame([("a", 1, 3, 0, ["x"], ["y"]), ("b", 2, 9, 1, None, None), ("c", 3, 9, 2, ["x"], ["y"])], SCHEMA)
    got = {r.cluster_id: (r.target, r.merged) for r in merge_fold(small, words).collect()}
    # "b" has no keywords: "c" needs none of them and joins the first cluster above the size.
    assert got == {"a": ("a", False), "b": ("b", False), "c": ("b", True)}
