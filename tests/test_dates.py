"""Date goldens (FIXTURES §6): chunk strings and resolved days, zone +08:00."""

import datetime as dt

from pyspark.sql import functions as F

from tidings.functions import dates as D

PUB = 1555862400000  # 2019-04-22 00:00 +08:00


def day_ms(y, m, d):
    return int((dt.datetime(y, m, d) - dt.datetime(1970, 1, 1)).total_seconds() * 1000) - 8 * 3600 * 1000


def run(spark, s, pub=PUB):
    df = spark.createDataFrame([(s, pub)], "s string, p long")
    return D.with_sentence_times(df, "s", "p", out="t").first().t


def test_range_with_bare_start(spark):
    t = run(spark, "全国工业和信息化工作会议17-18日上午在京召开")
    assert t.tmp_str == "17-18日上午"
    assert t.tmp_ms == PUB


def test_day_only(spark):
    t = run(spark, "高分五号和六号两颗卫星21日正式投入使用，标志着我国")
    assert t.tmp_str == "21日"
    assert t.tmp_ms == 1555776000000


def test_full_range(spark):
    t = run(spark, "去年是2019年5月21日（星期五）下午8点到2019年5月22日（星期六）上午9时一起去吃饭")
    assert t.tmp_str.startswith("2019年5月21日") and t.tmp_str.endswith("9时")
    assert t.tmp_ms == day_ms(2019, 5, 21)


def test_month_day(spark):
    t = run(spark, "去年是5月21日一起去吃饭")
    assert t.tmp_str == "5月21日" and t.tmp_ms == day_ms(2019, 5, 21)


def test_dateline_rpt(spark):
    t = run(spark, "新华社北京10月31日电中共中央政治局10月31日召开会议")
    assert t.rpt_str == "10月31日电"
    assert t.tmp_str == "10月31日"
    assert t.tmp_ms == day_ms(2019, 10, 31)


def test_no_date_is_publish_time(spark):
    t = run(spark, "没有日期的句子")
    assert t.tmp_ms == PUB and t.rpt_ms is None


def test_invalid_and_chinese_year(spark):
    assert run(spark, "会议于2月30日举行").tmp_ms is None
    assert run(spark, "二零一九年5月3日举行").tmp_ms is None


def test_hao_day_drops_times(spark):
    t = run(spark, "会议5月3号到6日举行")
    assert t.tmp_ms is None
