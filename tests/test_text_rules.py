"""Goldens from the reference's demo values (FIXTURES §5, §7) and regex twins."""

import re

from pyspark.sql import functions as F

from tidings.functions import rules as R
from tidings.functions import text as T


def one(spark, col_fn, value):
    return spark.createDataFrame([(value,)], "s string").select(col_fn(F.col("s")).alias("r")).first()["r"]


def test_semantic_clean_golden(spark):
    s = "  新华社北京10月31日电（记者闻飞翔）中共中央政治局10月31日召开【今天是星期5】会议，分析研究当前经济形势，部署当前经济工作"
    assert one(spark, T.semantic_clean, s) == "中共中央政治局10月31日召开会议，分析研究当前经济形势，部署当前经济工作"


def test_bracket_strip_nested(spark):
    assert one(spark, T.bracket_strip, "（a(b)c）") == "（ac）"


def test_dateline_late_feature_kept(spark):
    s = "中共中央政治局召开会议，分析研究当前经济形势31日电"
    assert one(spark, T.dateline_cut, s) == s


def test_chunk_offsets_match_finditer(spark):
    from tidings import config as C
    texts = ['a(b)c "x" (d) 《书》 [e] (f', "“引”(1)(2)‘q’'r'{z}「y」<t>【u】"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r["r"] for r in df.select(T.chunk_offsets(F.col("s")).alias("r")).collect()]
    for t, g in zip(texts, got):
        exp = []
        for o, e in C.CHUNK_PAIRS:
            for m in re.finditer("[{0}](.*?)[{1}]".format(re.escape(o), re.escape(e)), t):
                exp.append((o, m.group(0), m.start(), m.end()))
        assert [(x["type"], x["chunk"], x["start"], x["end"]) for x in g] == exp


def test_title_filter_cases(spark):
    t = "国家统计局：2018年经济总量突破90万亿GDP增速6.6%"
    assert one(spark, lambda c: R.title_filter(c), t) is True
    assert one(spark, lambda c: R.title_filter(c, extra_words=("利润", "减", "增", "涨")), t) is False
    assert one(spark, lambda c: R.title_filter(c), "5月3日 天气") is False
    assert one(spark, lambda c: R.title_filter(c), "月日") is False  # bare 月日 counts
    assert one(spark, lambda c: R.title_filter(c), "  ") is False
    assert one(spark, lambda c: R.title_filter(c), "某公司质押股份") is False


def test_paragraph_rule(spark):
    rpt = "据新华社郑州3月18日电  中共中央总书记在河南省兰考县调研指导党的群众路线教育实践活动时强调"
    tmp = "18日上午，习近平专门听取兰考县教育实践活动情况汇报，并发表重要讲话。"
    none = "习近平还对兰考县结合教育实践活动抓好当前改革发展稳定各项工作提出明确要求，希望他们"
    df = spark.createDataFrame([(rpt,), (tmp,), (none,), ("短",)], "s string")
    got = [r[0] for r in df.select(R.paragraph_kind(F.col("s"))).collect()]
    assert got == ["RPT", "TMP", "", ""]


def test_paragraphs_split_and_event_description(spark):
    content = "<p>短</p><p>１８日上午，习近平专门听取兰考县教育实践活动情况汇报，并发表重要讲话。</p><p>据新华社郑州3月18日电  中共中央总书记近日在河南省兰考县调研</p><p> </p>"
    df = spark.createDataFrame([("a", content, "CRAWL")], "id string, content string, dataSource string")
    paras = T.paragraphs(df, "id", "content", "dataSource")
    rows = paras.orderBy("p_pos").collect()
    assert [r.p_pos for r in rows] == [0, 1, 2]
    assert rows[1].text.startswith("18日上午")
    ed = R.event_description(paras.withColumn("kind", R.paragraph_kind(F.col("text"))), "id").first()
    assert ed.kind == "RPT" and ed.p_pos == 2


def test_title_classifier_order(spark):
    lists = {"abs_neg_strings": ("今日关注",), "pos_entities": ("国务院",), "neg_entities": ("股份",),
             "pos_strings": ("会议",), "neg_strings": ("价格",), "special_signs": ("快讯",), "neg_entities1": ()}
    seg = "array<struct<word:string,nature:string>>"
    rows = [("今日关注 国务院", []), ("国务院 股份", []), ("[快讯]国务院", []), ("台州椒江：活力", [("台州椒江", "ns")]),
            ("价格上涨", []), ("平常标题", [])]
    df = spark.createDataFrame(rows, f"t string, seg {seg}")
    got = [(r.c.keep, r.c.rule) for r in df.select(R.title_class(F.col("t"), F.col("seg"), lists).alias("c")).collect()]
    assert got == [(False, "abs_neg_string"), (True, "pos_entity"), (False, "special_sign"), (True, "ns_marked"),
                   (False, "neg_string"), (True, "default")]
