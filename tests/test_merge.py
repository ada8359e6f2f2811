"""Cluster keyword merge: rounds == sequential first fit on static keywords."""

import math
import random

from tidings.operators import clustering as CL


def pred(ti, tj, ci, cj):
    t, c = len(set(ti)), len(set(ci))
    to, co = len(set(ti) & set(tj)), len(set(ci) & set(cj))
    if to >= math.floor(0.6 * t) or co >= math.floor(0.8 * c):
        return True
    if to >= math.floor(0.4 * t) and co >= math.floor(0.5 * c):
        return True
    return to >= math.floor(0.2 * t) and co >= math.floor(0.6 * c)


def sequential(cl, status):
    accepted, target = [], {}
    now = {c["cid"]: status.get(c["id"]) for c in cl}  # of the id a cluster carries at present
    for c in cl:
        if c["size"] > 3:
            for j in accepted:
                if j["size"] > 3 and pred(c["kw"], j["kw"], c["ck"], j["ck"]):
                    if now[c["cid"]] == "1" and now[j["cid"]] == "1":
                        break
                    if now[c["cid"]] == "1" and now[j["cid"]] == "0":
                        now[j["cid"]] = "1"
                    target[c["cid"]] = j["cid"]
                    break
        if c["cid"] not in target:
            accepted.append(c)
            target[c["cid"]] = c["cid"]
    return target


def test_merge_rounds_match_sequential(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(9)]
    cl = []
    for n in range(60):
        kw = rnd.sample(vocab, rnd.randint(1, 5))
        ck = rnd.sample(vocab, rnd.randint(1, 5))
        cl.append({"cid": f"c{n:02d}", "id": n, "size": rnd.choice([2, 4, 5, 8]), "kw": kw, "ck": ck})
    cl.sort(key=lambda c: (-c["size"], c["id"]))
    status = {c["id"]: rnd.choice(["1", "0", "0"]) for c in cl if rnd.random() < 0.5}
    rows = [(c["cid"], c["id"], c["size"], (-c["size"], c["id"]), c["kw"], c["ck"]) for c in cl]
    df = spark.createDataFrame(rows, "cluster_id string, id long, size long, order struct<s:long,p:long>, "
                                     "keywords array<string>, content_keywords array<string>")
    st = spark.createDataFrame(list(status.items()), "id long, status string")
    got = {r.cluster_id: r.target for r in CL.merge_clusters(df, st).collect()}
    assert got == sequential(cl, status)


def test_second_protected_cluster_stays_apart(spark):
    kw = [f"k{i}" for i in range(5)]
    rows = [(c, i, 9 - i, (i - 9, i), kw, kw) for i, c in enumerate("ABCD", 1)]
    df = spark.createDataFrame(rows, "cluster_id string, id long, size long, order struct<s:long,p:long>, "
                                     "keywords array<string>, content_keywords array<string>")
    st = spark.createDataFrame([(1, "0"), (2, "1"), (3, "1")], "id long, status string")
    merge = CL.merge_clusters(df, st)
    assert {r.cluster_id: r.target for r in merge.collect()} == {"A": "A", "B": "A", "C": "C", "D": "A"}
    assert sorted(r.id for r in CL.tombstones(merge).collect()) == [1, 4]
