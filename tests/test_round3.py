"""Steps that were made or written more than once: plans over rows of the tests' own, results against plain Python."""

import re

import pytest
from pyspark.sql import functions as F

from tidings.operators import annotate as A
from tidings.operators import features as FE
from tidings.plans import catalog_annotate as CA
from tidings.plans import catalog_events as CE
from tidings.plans import catalog_features as CF
from tidings.plans import catalog_merge as CM
from tidings.plans import standins as S

TEXTS = ["The Big dog barked at the dog. Nobody saw it, running; one two three four five six seven eight.\nBig Cats. x",
         "", None, "Big Dogs ran. ran ran Alice Bob met Alice walking home. jumped", "lower case only. Nothing."]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, "en", f"s{i % 2}") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "en", "s1")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{d}/documents.parquet")
    return d


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_stand_in_nature_is_the_pattern_rule(spark):
    runs = ["Walking", "walking", "redED", "Zed", "aZ", "z", "A", "ing", "Ed", "thing", "edx"]
    got = spark.createDataFrame([(" ".join(runs),)], "t string").select(S.seg(F.col("t")).alias("s")).first().s
    rule = lambda x: "nz" if re.match("[A-Z]", x) else "v" if re.search("(ing|ed)$", x.lower()) else "n"
    assert [(t.word, t.nature) for t in got] == [(x.lower(), rule(x)) for x in runs]


@pytest.mark.parametrize("make", [CF.bag, CF.article_bag])
def test_bags_find_words_once_and_store_nothing(spark, tables, make):
    text = plan(make(spark, tables))
    assert "InMemoryRelation" not in text and "Filter (size(concat" not in text


def test_completion_stores_no_sentences(spark, tables):
    text = plan(CE.completion_q(spark, tables))
    assert "InMemoryRelation" not in text and "sentence" not in text


def test_members_hold_no_texts(spark, tables):
    assert "content" not in CM.members(spark, tables).columns


def test_member_terms_of_repeated_ids_weigh_as_in_the_join(spark, tables):
    """Two documents of one id make four members, and each text counts for both."""
    got = {r.cluster_id: r.content_keywords for r in CM.clusters(spark, tables).collect()}
    assert CM.members(spark, tables).where("id = 3").count() == 4
    assert set(got) == {"s0/en", "s1/en"} and got["s1/en"][:2] == ["ran", "alice"]


def test_coarse_tokens_without_joins(spark):
    sents = spark.createDataFrame([
        (1, 0, ["a", "b", "c", "d", "e"], ["n", "n", "v", "n", "n"], ["S-Nh", "S-Nh", "O", "S-Ni", "S-Nh"]),
        (1, 1, ["x", "y"], ["n", "v"], ["O", "O"]), (None, 2, ["p", "q"], ["n", "n"], ["S-Nh", "O"])],
        "d long, s int, words array<string>, postags array<string>, netags array<string>")
    sents = sents.withColumn("arcs", F.transform("words", lambda w: F.struct(F.lit(0).alias("head"), F.lit("HED").alias("rel"))))
    df = A.coarse_tokens(sents, ["d", "s"])
    assert "Join" not in plan(df)
    # A sentence without a key keeps its chunks, as joins on the key left it.
    assert sorted(map(tuple, df.collect()), key=str) == sorted([
        (1, 0, 0, "ab", "nh"), (1, 0, 2, "c", "v"), (1, 0, 3, "d", "ni"), (1, 0, 4, "e", "nh"), (None, 2, 0, "p", "nh")], key=str)


def test_tokens_are_exchanged_as_sentences(spark, tables):
    for q in (CA.child_map_q, CA.ner_islands_q, CA.coarse_tokens_q):
        df = q(spark, tables)
        text = df._jdf.queryExecution().sparkPlan().toString()
        executed = df._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan" not in text and "Join" not in text and executed.count("Exchange hashpartitioning") == 1


def test_core_words_of_long_chains(spark):
    """A chain of n COO tokens, a cycle, and an explosion that does not copy the sentence."""
    n = 37
    chain = [(0, "HED")] + [(i, "COO") for i in range(1, n)] + [(n + 2, "COO"), (n + 1, "COO")]
    df = A.core_words(spark.createDataFrame([(1, [f"w{i}" for i in range(n + 2)], chain), (2, ["a", "b"], [(0, "HED"), (1, "COO")]), (3, ["z"], [(0, "HED")])],
                                            "k int, words array<string>, arcs array<struct<head:int,rel:string>>"), ["k"])
    got = sorted(map(tuple, df.collect()))
    assert [(r[1], r[2]) for r in got if r[0] == 1] == [(i, i) for i in range(n)]
    assert [r[1:] for r in got if r[0] > 1] == [(0, 0, "a", 0), (1, 1, "b", 1), (0, 0, "z", 0)]


def test_long_sentence_with_many_chunks(spark):
    """Ten thousand tokens with a chunk at every fifth: one fold, linear in both."""
    n = 10_000
    seg = [("w", "n", i) for i in range(n)]
    chunks = [("(w)", i, i + 3) for i in range(0, n, 5)]
    df = spark.createDataFrame([(seg, chunks), (seg[:3], [])], "seg array<struct<word:string,nature:string,offset:int>>, ch array<struct<chunk:string,start:int,end:int>>")
    long, short = [r.m for r in df.select(A.merge_chunk_tokens(F.col("seg"), F.col("ch")).alias("m")).collect()]
    assert len(long) == n // 5 * 3 and tuple(long[0]) == ("(w)", "n", 0) and tuple(long[1]) == ("w", "n", 3)
    assert [tuple(t) for t in short] == seg[:3]
