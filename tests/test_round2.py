"""Deep chains, Unicode blanks, sentence times, string ids, corpus size."""

import math

from pyspark.sql import functions as F

from tidings.functions import dates, rules, text
from tidings.operators import annotate, features, keywords
from tidings.sources import scan


def parses(spark, *sentences):
    rows = [(i, [f"w{j}" for j in range(len(arcs))], ["n"] * len(arcs), arcs) for i, arcs in enumerate(sentences)]
    return spark.createDataFrame(rows, "sid int, words array<string>, postags array<string>, arcs array<struct<head:int,rel:string>>")


def test_core_words_follow_deep_chains(spark):
    deep = [(0, "HED")] + [(i, "COO") for i in range(1, 5000)]
    back = [(i + 2, "COO") for i in range(9)] + [(0, "HED")]
    cycle = [(2, "COO"), (1, "COO"), (0, "HED"), (3, "COO"), (4, "ATT"), (9, "COO"), (0, "COO")]
    rows = annotate.core_words(parses(spark, deep, back, cycle, []), ["sid"]).collect()
    got = {(r.sid, r.idx): (r.depth, r.word) for r in rows}
    assert {k: v for k, v in got.items() if k[0] == 0} == {(0, i): (i, f"w{i}") for i in range(5000)}
    assert {k: v[0] for k, v in got.items() if k[0] == 1} == {(1, i): 9 - i for i in range(10)}
    assert {k: v[0] for k, v in got.items() if k[0] == 2} == {(2, 2): 0, (2, 3): 1}
    assert next(r.offe for r in rows if (r.sid, r.idx) == (0, 12)) == 10 * 2 + 2 * 3


def test_unicode_blanks(spark):
    row = spark.createDataFrame([("　　", "　a b ", "a b　c")], "x string, y string, z string").select(
        rules.title_filter(F.col("x")).alias("keep"), text.title_segments(F.col("y")).alias("seg"), text.remove_whitespace(F.col("z")).alias("z")).first()
    assert row.keep is False and row.seg == ["a", "b"] and row.z == "abc"


def test_sentence_without_date_takes_the_article_time(spark):
    rows = spark.createDataFrame([("今天没有日期", 1555862400000, 1540915200000), ("会议10月31日召开", 1555862400000, 5)], "s string, p long, a long")
    timed = dates.with_sentence_times(rows, "s", "p").select(dates.sentence_tmp(F.col("times"), F.col("a")).alias("t"), "times.tmp_ms").collect()
    assert timed[0].t == 1540915200000 and timed[0].tmp_ms == 1555862400000
    assert timed[1].t == timed[1].tmp_ms != 5


def test_textrank_takes_string_ids(spark):
    seg = [{"word": w, "nature": "n"} for w in ["alpha", "beta", "alpha", "gamma"]]
    rows = spark.createDataFrame([("a-1", seg)], "id string, seg array<struct<word:string,nature:string>>")
    assert {r.id for r in keywords.textrank(rows, "id", "seg", natures=("n",)).collect()} == {"a-1"}


def test_corpus_size_counts_empty_documents(spark):
    bag = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "x", 1)], "id int, term string, tf long")
    articles = spark.range(4)
    w = {(r.id, r.term): r.w for r in features.tfidf(bag, "id", articles=articles).collect()}
    assert math.isclose(w[1, "x"] / w[1, "y"], math.log2(4 / 2) / (2 * math.log2(4 / 1)))


def test_slot_batches_match_the_plain_rule(spark):
    import random
    rng = random.Random(4)
    times = [rng.randrange(0, 4000) for _ in range(3000)]
    rows = scan.slot_batches(spark.createDataFrame([(t,) for t in times], "publishAt long"), 0, 10, 25).orderBy("slot").collect()
    counts = {}
    for t in times:
        counts[t // 10] = counts.get(t // 10, 0) + 1
    batch = held = 0
    for r, (slot, n) in zip(rows, sorted(counts.items()), strict=True):
        batch, held = (batch + 1, n) if held >= 25 else (batch, held + n)
        assert (r.slot, r.n, r.batch) == (slot, n, batch)


def test_mark_defaults_only_without_a_folder(spark, tmp_path):
    root = str(tmp_path / "marks")
    assert scan.read_mark(spark, root, 7) == 7
    scan.write_mark(spark, root, 1, 11)
    scan.write_mark(spark, root, 2, 12)
    assert scan.read_mark(spark, root, 7) == 12


def test_textrank_reads_one_document_at_a_time(spark):
    seg = "array<struct<word:string,nature:string>>"
    rows = spark.createDataFrame([(i, [("red", "n"), ("blue", "n"), (f"w{i}", "n")]) for i in range(40)] + [(99, None), (100, [])], f"id long, seg {seg}")
    ranked = keywords.textrank(rows, "id", "seg", natures=("n",))
    assert "MapInArrow" in ranked._jdf.queryExecution().sparkPlan().toString()  # a pandas batch held the tokens of 10,000 documents as objects
    got = {}
    for r in ranked.collect():
        got.setdefault(r.id, []).append((r.rank, r.word, r.weight))
    assert set(got) == set(range(40))
    for i, found in got.items():
        want = keywords.rank_document([("red", "n"), ("blue", "n"), (f"w{i}", "n")], frozenset(["n"]), frozenset())
        assert sorted(found) == [(r + 1, w, s) for r, (w, s) in enumerate(want)]
