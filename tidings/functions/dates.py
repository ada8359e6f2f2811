"""Report-time / event-time extraction and resolution (D1–D7), as Java regex
built-ins: ordered ``coalesce`` of ``regexp_extract`` hits, then an
anchored parse of year / month / day with the reference's fall-back chain.

Fixed values below (time vocabulary and the numeral list) must equal the
original pipeline's; the 55 event-time patterns are *generated* from their
building blocks (7 heads × 8 suffixes − 1) instead of being listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import DEFAULT_TZ, local_ms_of_date, local_wall_time

# --- fixed values -----------------------------------------------------------
WEEK = "星期|周"
HOUR = "时|点"
PERIOD = "上午|中午|晚上|下午|晨|晚|全天"
TYPES = "报道|消息|讯|获悉|公布|电|号"
SEPS = "-|到|至|—|和|－"
CN_DIGITS = "零一二两三四五六七八九十"
CN_NUMERALS = ("一", "二", "三", "四", "五", "六", "七", "八", "九", "十", "十一", "十二", "十三", "十四", "十五",
               "十六", "十七", "十八", "十九", "二十", "二十一", "二十二", "二十三", "二十四", "二十五", "二十六",
               "二十七", "二十八", "二十九", "三十", "三十一")
PART_RULES = (f"([0-9{CN_DIGITS}]+年)", "([0-9一二两三四五六七八九十]+月)", "([0-9一二两三四五六七八九十]+[号日])")
ANCHORED = ("^([0-9零一二两三四五六七八九十]+年)?([0-9一二两三四五六七八九十]+月)?"
            "([0-9一二两三四五六七八九十]+[号日])?")
# -----------------------------------------------------------------------------

CN4 = f"[{CN_DIGITS}]{{1,4}}"
CN2 = f"[{CN_DIGITS}]{{1,2}}"
NL = f"(?!{TYPES})"


def rpt_patterns() -> list[str]:
    """Report-time chunks, in priority order."""
    return [
        f"({CN4}年|\\d{{1,4}}年)(.{{0,7}}?)(日)({TYPES})",
        f"({CN2}月|\\d{{1,2}}月)(.{{0,2}})(日)({TYPES})",
        f"({CN2}日|\\d{{1,2}}日)({TYPES})",
    ]


def tmp_patterns() -> list[str]:
    """Event-time chunks, in priority order: range heads (year, month, day,
    bare number) then single heads (year, month, day); within a head the
    suffixes weekday-paren+period+hour, paren+period, paren+hour,
    period+hour, paren, hour, period, none (bare number: no first one)."""
    hour = f"({CN2}{HOUR.split('|')[0]}|{HOUR.split('|')[1]}|\\d{{1,2}}{HOUR.split('|')[0]}|{HOUR.split('|')[1]})"
    paren = "[(|（](.*?)[)|）]"
    period = f"({PERIOD})"
    suffixes = [paren + period + hour, paren + period, paren + hour, period + hour, paren, hour, period, ""]
    tail = f"(.{{0,9}})({SEPS})(.{{0,11}})(日){NL}"
    range_heads = [
        f"({CN4}年|\\d{{1,4}}年)(.{{0,7}})(日){NL}",
        f"({CN2}月|\\d{{1,2}}月)(.{{0,5}})(日){NL}",
        f"({CN4}日|\\d{{1,2}}日){NL}",
        f"({CN4}|\\d{{1,2}}){NL}",
    ]
    single_heads = [
        f"({CN4}年|\\d{{1,4}}年)(.{{0,7}})(日)",
        f"({CN2}月|\\d{{1,2}}月)(.{{0,5}})(日)",
        f"({CN4}日|\\d{{1,2}}日)",
    ]
    out = []
    for i, h in enumerate(range_heads):
        for j, s in enumerate(suffixes):
            if i == 3 and j == 0:
                continue
            out.append(h + tail + s)
    for h in single_heads:
        for s in suffixes:
            out.append(h + s + NL)
    return out


def first_hit(s: Column, patterns) -> Column:
    """The first pattern's (in list order) leftmost match, or NULL; no pattern after the first hit is tried."""
    hits = [F.regexp_extract(s, p, 0) for p in patterns]
    return F.coalesce(*[F.when(h != "", h) for h in hits])


def split_range(chunk: Column) -> Column:
    """D3: greedy split at the last separator → [start, end], else [chunk]."""
    p = f"(.*)({SEPS})(.*)"
    has = chunk.rlike(p)
    return F.when(chunk.isNull(), F.array().cast("array<string>")) \
            .when(has, F.array(F.regexp_extract(chunk, p, 1), F.regexp_extract(chunk, p, 3))) \
            .otherwise(F.array(chunk))


def date_chunks(s: Column) -> Column:
    """D1 + D2: struct<rpt, tmp> chunk strings of one sentence (NULL = none).

    Every pattern contains 日, so sentences without it skip the regex grid."""
    has_day = F.instr(s, "日") > 0
    none = F.lit(None).cast("string")
    return F.struct(F.when(has_day, first_hit(s, rpt_patterns())).otherwise(none).alias("rpt"),
                    F.when(has_day, first_hit(s, tmp_patterns())).otherwise(none).alias("tmp"))


def _numeral(x: Column) -> Column:
    """'21' → 21, Chinese numeral ≤ 31 → its value, anything else → NULL."""
    m = F.create_map(*[v for i, n in enumerate(CN_NUMERALS) for v in (F.lit(n), F.lit(i + 1))])
    return F.coalesce(F.try_element_at(m, x), x.try_cast("int"))


def _part_of(rule: str):
    return lambda x: F.regexp_extract(x, rule, 1)


def resolve(parts: Column, publish_ms: Column, tz: str = DEFAULT_TZ) -> Column:
    """array<string> of time strings (RPT parts then TMP parts) →
    array<bigint> epoch ms of local midnight per string.

    Each string is parsed as (year?)(month?)(day?) from its start; a missing
    part is looked up in this string and then in earlier strings (from the
    first equal string backwards), else taken from the publish date.  A day
    written with 号 makes the whole sentence fail (→ NULL array); an invalid
    or Chinese-year date gives NULL (the reference's 0).
    """
    wall = local_wall_time(publish_ms, tz)
    pub = [F.concat(F.year(wall).cast("string"), F.lit("年")),
           F.concat(F.lpad(F.month(wall).cast("string"), 2, "0"), F.lit("月")),
           F.concat(F.lpad(F.dayofmonth(wall).cast("string"), 2, "0"), F.lit("日"))]

    def one(msg: Column) -> Column:
        first = F.array_position(parts, msg).cast("int")  # 1-based first equal string
        earlier = F.reverse(F.slice(parts, 1, first))
        got = []
        for k in range(3):
            own = F.regexp_extract(msg, ANCHORED, k + 1)
            back = F.try_element_at(F.filter(F.transform(earlier, _part_of(PART_RULES[k])), lambda y: y != ""), F.lit(1))
            got.append(F.when(own != "", own).otherwise(F.coalesce(back, pub[k])))
        y = F.regexp_extract(got[0], "^(.+?)年", 1)
        m = F.regexp_extract(got[1], "^(.+?)月", 1)
        d = F.regexp_extract(got[2], "^(.+?)日", 1)
        bad = F.regexp_extract(got[2], "^(.+?)日", 0) == ""  # 号 day: the reference raises
        date = F.try_make_timestamp_ntz(y.try_cast("int"), _numeral(m), _numeral(d),
                                        F.lit(0), F.lit(0), F.lit(0))
        return F.struct(bad.alias("bad"), local_ms_of_date(F.to_date(date), tz).alias("ms"))

    res = F.transform(parts, one)
    return F.when(F.exists(res, lambda r: r["bad"]), F.lit(None).cast("array<bigint>")) \
            .otherwise(F.transform(res, lambda r: r["ms"]))


def with_sentence_times(df: DataFrame, text_col: str, publish_col: str, tz: str = DEFAULT_TZ,
                        out: str = "times") -> DataFrame:
    """D1–D5 as staged columns: adds struct ``out`` <rpt_str, tmp_str, rpt_ms,
    tmp_ms>.  No chunk at all → TMP = publishAt (D5); a failing parse (号
    day) drops all times.  Each stage is its own projection so the large
    pattern expressions are evaluated once per row."""
    ch = "_dt_chunks"
    df = df.withColumn(ch, date_chunks(F.col(text_col)))
    df = df.withColumn("_dt_rp", split_range(F.col(f"{ch}.rpt"))).withColumn("_dt_tp", split_range(F.col(f"{ch}.tmp")))
    df = df.withColumn("_dt_ms", resolve(F.concat(F.col("_dt_rp"), F.col("_dt_tp")), F.col(publish_col), tz))
    none = F.col(f"{ch}.rpt").isNull() & F.col(f"{ch}.tmp").isNull()
    rpt_ms = F.when(F.col(f"{ch}.rpt").isNotNull(), F.try_element_at("_dt_ms", F.lit(1)))
    tmp_ms = (F.when(none, F.col(publish_col))
               .when(F.col(f"{ch}.tmp").isNotNull(), F.try_element_at(F.col("_dt_ms"), F.size("_dt_rp") + 1)))
    df = df.withColumn(out, F.struct(F.col(f"{ch}.rpt").alias("rpt_str"), F.col(f"{ch}.tmp").alias("tmp_str"),
                                     rpt_ms.alias("rpt_ms"), tmp_ms.alias("tmp_ms")))
    return df.drop(ch, "_dt_rp", "_dt_tp", "_dt_ms")


def article_times(first_rpt: Column, first_tmp: Column, publish_ms: Column) -> Column:
    """Article RPT = first RPT start else publishAt; article TMP = first
    TMP start (NULL when only an RPT was found)."""
    return F.struct(F.coalesce(first_rpt, publish_ms).alias("rpt_ms"), first_tmp.alias("tmp_ms"))


def sentence_tmp(times: Column, article_tmp: Column) -> Column:
    """A sentence's TMP is that of its own event-time chunk, else the article's.

    ``times`` is the struct of ``with_sentence_times``; the publish time that D5
    gives a sentence without any chunk does not count as its own.
    """
    return F.coalesce(F.when(times["tmp_str"].isNotNull(), times["tmp_ms"]), article_tmp)
