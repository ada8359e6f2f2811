"""Whole articles: description, times, titles, sentences, triples, entities, packed in order."""
import re

from pyspark.sql import functions as F

from tidings import config as C
from tidings.operators import articles as AR
from tidings.operators.annotate import ner_islands

SCHEMA = "id long, title string, content string, dataSource string, publishAt long"
DAY = 86_400_000
PUBLISHED = 1704067200000 + 40 * 3_600_000  # 3 January 2024 in Shanghai

DATELINE = "新华社北京1月2日电 主席访问公园。1月1日大会通过《新 法》；代表离开，没有动词。"


def segment(df):
    """Runs of letters or digits, fixed words, else single signs; verbs are 访问, 通过, 离开."""
    words = F.regexp_extract_all("sentence", F.lit("访问|通过|离开|主席|公园|大会|代表|[0-9]+|."), 0)
    offsets = F.transform(words, lambda w, i: F.length(F.array_join(F.slice(words, F.lit(1), i), "")))
    return df.withColumn("seg", F.transform(words, lambda w, i: F.struct(
        w.alias("word"), F.when(w.isin("访问", "通过", "离开"), "v").otherwise("n").alias("nature"), F.get(offsets, i).alias("offset"))))


def parse(df):
    """The first verb is the root, what stands before and after it its subject and object; the subject is an entity."""
    root = F.array_position("postags", "v").cast("int")

    def arc(p, i):
        head = F.when(i + 1 == root, 0).otherwise(root)
        rel = F.when(i + 1 == root, "HED").when(i + 2 == root, "SBV").when(i == root, "VOB").otherwise("WP")
        return F.struct(head.alias("head"), rel.alias("rel"))

    return df.withColumn("arcs", F.transform("postags", arc)).withColumn("netags", F.transform("words", lambda w: F.when(w == "主席", "S-Nh").when(w == "公园", "S-Ns").otherwise("O")))


def test_article_is_read_in_one_pass(spark):
    rows = [
        (1, " 主席访问公园  大会通过 ", "<p>" + "前言" * 20 + "</p></p><p><p>" + DATELINE + "</p>", "API", PUBLISHED),
        (2, "无事", "没有日期的一段话" * 5, "API", PUBLISHED), (3, None, DATELINE, "API", PUBLISHED), (4, "t", None, "API", PUBLISHED),
        (5, "代表", "日前代表离开大会，其余的话补足长度长度长度长度。", "CRAWL", PUBLISHED),
    ]
    found = {r.id: r for r in AR.annotate(spark.createDataFrame(rows, SCHEMA).withColumn("extra", F.lit("kept")), segment, parse).collect()}
    assert set(found) == {1, 5} and found[1].extra == "kept"
    one = found[1]
    assert one.event_description == DATELINE
    # The dateline gives the report time, the first event date the article's.
    midnight = (PUBLISHED + 8 * 3_600_000) // DAY * DAY - 8 * 3_600_000
    assert one.rpt_ms == midnight - DAY and one.tmp_ms == midnight - 2 * DAY
    assert [t.sentence for t in one.titles_info] == ["主席访问公园", "大会通过"]
    assert [(t.sub, t.verb, t.obj) for t in one.titles_info[0].triples] == [("主席", "访问", "公园")]
    assert [n.name for n in one.titles_info[0].ners] == ["主席", "公园"] and [n.type for n in one.titles_info[0].ners] == ["Nh", "Ns"]
    sentences = [s.sentence for s in one.sentences_info]
    assert sentences == ["主席访问公园", "1月1日大会通过《新法》", "代表离开", "没有动词"]
    # A sentence's own date, else the article's; F4: the quoted chunk is one word.
    assert [s.tmp_ms for s in one.sentences_info] == [midnight - 2 * DAY] * 4
    assert one.sentences_info[1].words[-1] == "《新法》" and [(t.sub, t.verb, t.obj) for t in one.sentences_info[1].triples] == [("大会", "通过", "《新法》")]
    assert one.sentences_info[3].triples == [] and {s.rpt_ms for s in one.sentences_info} == {one.rpt_ms}
    # No date at all: the publication time (D5), as report time too.
    assert found[5].rpt_ms == PUBLISHED and [s.sentence for s in found[5].sentences_info][0].startswith("日前代表离开")


def test_triples_in_order_with_core_verbs(spark):
    rows = [(1, "主席访问公园 大会通过", DATELINE, "API", PUBLISHED)]
    whole = AR.annotate(spark.createDataFrame(rows, SCHEMA), segment, parse).withColumn("cluster", F.lit("c"))
    got = AR.triple_rows(whole, "cluster").orderBy("part", "at", "k").collect()
    assert [(r.part, r.at, r.sub, r.verb, r.obj, r.core) for r in got] == [
        (0, 0, "主席", "访问", "公园", True), (0, 1, "大会", "通过", "", True), (1, 0, "主席", "访问", "公园", True),
        (1, 1, "大会", "通过", "《新法》", True), (1, 2, "代表", "离开", "", True)]
    assert AR.triple_rows(whole.limit(0)).count() == 0


def test_title_rule_and_empty_table(spark):
    df = spark.createDataFrame([(1, "主席", DATELINE, "API", PUBLISHED)], SCHEMA)
    assert AR.annotate(df, segment, parse, title_rule=lambda t: ~F.contains(t, F.lit("主席"))).count() == 0
    assert AR.annotate(df, segment, parse, C.Config(sentence_mark="。", sentence_soft_marks="")).select(F.size("sentences_info")).first()[0] == 2


def test_entity_chunks_like_islands(spark):
    rows = [(1, list("abcdef"), ["S-Nh", "B-Nh", "O", "S-Ni", "S-Ns", "E-Ns"]), (2, ["a"], ["O"]), (3, [], []), (4, list("ab"), ["O", "S-Nh"])]
    df = spark.createDataFrame(rows, "s int, words array<string>, netags array<string>")
    want = sorted((r.s, r.start, r.end, r.type, r.name) for r in ner_islands(df, ["s"]).collect())
    got = df.select("s", F.explode(AR.entity_chunks(F.col("words"), F.col("netags"))).alias("c")).collect()
    assert sorted((r.s, r.c.start, r.c.end, r.c.type, r.c.name) for r in got) == want
    assert re.fullmatch("ab", want[0][4])
