"""Text, paragraph and title-rule queries (T*, P*) over pages and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as T
from . import standins as S
from .registry import query

# Latin stand-in parameters (the defaults are the Chinese fixed values).
LAT_RPT = (" dans ", " avec ")
LAT_TMP_REGEX = "^[^\\n]*[0-9]"
LAT_DATE_WORDS = (" pour ", " und ")
LAT_DATELINE = (" la ", " the ", " der ", " el ")
LAT_FILTER_TERMS = ("ouen", "thorre")
LAT_FILTER_DATE = "[0-9]+"
LAT_FILTER_PAIRS = (("the", "and"), ("le", "de"), ("und", "der"))
LAT_TITLE_LISTS = {
    "abs_neg_strings": ("zzz",),
    "neg_entities1": ("Ouch",),
    "special_signs": ("ad",),
    "pos_entities": ("The ",),
    "neg_entities": ("Le ",),
    "pos_strings": ("tion",),
    "neg_strings": ("ment",),
}

STRIP_SQL = "regexp_replace({x}, '^[ \\t\\n\\r\\f]+|[ \\t\\n\\r\\f]+$', '', 'g')"


def _sql_contains_any(expr: str, words) -> str:
    words = [w for w in words if w]
    if not words:
        return "false"
    return "(" + " OR ".join(f"contains({expr}, '{w}')" for w in words) + ")"


def pages(spark, sf_dir):
    p = S.table(spark, sf_dir, "pages")
    return p.select(F.col("page_id").alias("id"), F.col("html").alias("content"),
                    F.when(F.col("url").startswith("https"), F.lit("CRAWL")).otherwise(F.lit("API")).alias("dataSource"))


PAGES_SQL = """pages_a AS (
  SELECT page_id AS id, html AS content, CASE WHEN starts_with(url, 'https') THEN 'CRAWL' ELSE 'API' END AS dataSource
  FROM pages)"""

PARAS_SQL = f"""{PAGES_SQL},
pieces AS (
  SELECT id, unnest(l) AS raw, generate_subscripts(l, 1) - 1 AS p_pos
  FROM (SELECT id, string_split(translate(content, '０１２３４５６７８９', '0123456789'),
                                CASE WHEN dataSource = 'CRAWL' THEN '</p><p>' ELSE '</p></p><p><p>' END) AS l
        FROM pages_a)),
paras AS (
  SELECT id, p_pos, regexp_replace(raw, '<[^>]+>', '', 'g') AS text FROM pieces
  WHERE length({STRIP_SQL.format(x="regexp_replace(raw, '<[^>]+>', '', 'g')")}) > 0)"""


def paras_df(spark, sf_dir):
    return T.paragraphs(pages(spark, sf_dir), "id", "content", "dataSource")


def kind_col(c):
    return R.paragraph_kind(c, features=LAT_RPT, date_regex=LAT_TMP_REGEX, date_words=LAT_DATE_WORDS)


KIND_SQL = f"""CASE WHEN NOT (length(text) > 20 AND length(text) < 500) THEN ''
  WHEN {_sql_contains_any('text', LAT_RPT)} THEN 'RPT'
  WHEN regexp_matches(text, '^[^\\n]*[0-9]') THEN 'TMP'
  WHEN {_sql_contains_any('text', LAT_DATE_WORDS)} THEN 'TMP' ELSE '' END"""


@query("strip_tags", "SELECT page_id, regexp_replace(html, '<[^>.*]+>', '', 'g') AS text FROM pages")
def strip_tags_q(spark, sf_dir):
    return S.table(spark, sf_dir, "pages").select("page_id", T.strip_tags(F.col("html")).alias("text"))


@query("remove_tags", "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS text FROM pages")
def remove_tags_q(spark, sf_dir):
    return S.table(spark, sf_dir, "pages").select("page_id", T.remove_tags(F.col("html")).alias("text"))


_FULL = "　" + "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_HALF = " " + "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))


@query("halfwidth", "SELECT doc_id, translate(text, '" + _FULL.replace("'", "''") + "', '" + _HALF.replace("'", "''") + "') AS text FROM documents")
def halfwidth_q(spark, sf_dir):
    return S.table(spark, sf_dir, "documents").select("doc_id", T.halfwidth(F.col("text")).alias("text"))


@query("paragraphs", f"WITH {PARAS_SQL} SELECT id, p_pos, text FROM paras")
def paragraphs_q(spark, sf_dir):
    return paras_df(spark, sf_dir)


@query("para_rule", f"WITH {PARAS_SQL} SELECT id, p_pos, {KIND_SQL} AS kind FROM paras")
def para_rule_q(spark, sf_dir):
    return paras_df(spark, sf_dir).select("id", "p_pos", kind_col(F.col("text")).alias("kind"))


@query("event_description", f"""WITH {PARAS_SQL},
k AS (SELECT id, p_pos, text, {KIND_SQL} AS kind FROM paras)
SELECT id, p_pos, kind, event_description FROM (
  SELECT id, p_pos, kind, text AS event_description,
         row_number() OVER (PARTITION BY id ORDER BY CASE WHEN kind = 'RPT' THEN 0 ELSE 1 END, p_pos) AS rn
  FROM k WHERE kind <> '') WHERE rn = 1""")
def event_description_q(spark, sf_dir):
    p = paras_df(spark, sf_dir).withColumn("kind", kind_col(F.col("text")))
    return R.event_description(p, "id")


def _dateline_sql(expr: str, feats) -> str:
    out = expr
    for f in reversed(feats):
        idx = f"(strpos({expr}, '{f}') - 1)"
        out = (f"CASE WHEN {idx} >= 0 AND {idx} < length({expr}) // 2 "
               f"THEN substring({expr}, {idx} + 1 + {len(f)}) ELSE {out} END")
    return out


@query("dateline_cut", f"SELECT doc_id, {_dateline_sql('text', LAT_DATELINE)} AS text FROM documents")
def dateline_cut_q(spark, sf_dir):
    d = S.table(spark, sf_dir, "documents")
    return d.select("doc_id", T.dateline_cut(F.col("text"), LAT_DATELINE).alias("text"))


def _bracket_lists_sql(expr: str, types) -> str:
    import re
    from .. import config as C
    parts = []
    for o, e in C.CHUNK_PAIRS:
        if o in types:
            pat = T.chunk_regex(o, e).replace("'", "''")
            parts.append(f"regexp_extract_all({expr}, '{pat}')")
    return "list_concat(" + ", ".join(parts) + ")" if len(parts) > 1 else parts[0]


def _clean_sql(expr: str) -> str:
    from .. import config as C
    return f"list_reduce({_bracket_lists_sql(expr, C.CLEAN_CHUNK_TYPES)}, lambda acc, x: replace(acc, x, ''), {expr})"


@query("bracket_strip", f"SELECT doc_id, {_clean_sql('text')} AS text FROM documents")
def bracket_strip_q(spark, sf_dir):
    d = S.table(spark, sf_dir, "documents")
    return d.select("doc_id", T.bracket_strip(F.col("text")).alias("text"))


@query("semantic_clean", f"""SELECT doc_id, {_clean_sql('c')} AS text
FROM (SELECT doc_id, {_dateline_sql('text', LAT_DATELINE)} AS c FROM documents)""")
def semantic_clean_q(spark, sf_dir):
    d = S.table(spark, sf_dir, "documents")
    return d.select("doc_id", T.semantic_clean(F.col("text"), LAT_DATELINE).alias("text"))


def _chunks_sql() -> str:
    from .. import config as C
    parts = []
    for i, (o, e) in enumerate(C.CHUNK_PAIRS):
        pat = T.chunk_regex(o, e).replace("'", "''")
        parts.append(f"""SELECT doc_id, {i} AS type_no, '{o.replace("'", "''")}' AS type, unnest(l) AS chunk,
       generate_subscripts(l, 1) AS k FROM (SELECT doc_id, regexp_extract_all(text, '{pat}') AS l FROM documents)""")
    return "\nUNION ALL\n".join(parts)


@query("chunks", f"""SELECT doc_id, type, chunk, ord FROM (
  SELECT doc_id, type, chunk, row_number() OVER (PARTITION BY doc_id ORDER BY type_no, k) - 1 AS ord
  FROM ({_chunks_sql()}))""")
def chunks_q(spark, sf_dir):
    d = S.table(spark, sf_dir, "documents")
    return (d.select("doc_id", F.posexplode(T.chunk_strings(F.col("text"))).alias("ord", "c"))
             .select("doc_id", F.col("c.type").alias("type"), F.col("c.chunk").alias("chunk"), F.col("ord").cast("bigint").alias("ord")))


@query("chunk_offsets")
def chunk_offsets_q(spark, sf_dir):
    """T7 with 0-based offsets (checked against ``re.finditer`` in tests)."""
    d = S.table(spark, sf_dir, "documents")
    return (d.select("doc_id", F.posexplode(T.chunk_offsets(F.col("text"))).alias("ord", "c"))
             .select("doc_id", "ord", "c.type", "c.chunk", "c.start", "c.end"))


@query("sentences", """SELECT doc_id, s_idx, sentence FROM (
  SELECT doc_id, unnest(l) AS sentence, generate_subscripts(l, 1) - 1 AS s_idx
  FROM (SELECT doc_id, string_split(translate(text, ';,', '..'), '.') AS l FROM documents))
WHERE length(sentence) > 0 AND length(sentence) < 500""")
def sentences_q(spark, sf_dir):
    d = S.table(spark, sf_dir, "documents")
    arr = T.sentence_array(F.col("text"), mark=".", soft=";,", strip_ws=False)
    return d.select("doc_id", F.explode(arr).alias("s")).select("doc_id", "s.s_idx", "s.sentence")


@query("title_segments", f"""WITH {S.ARTICLES_SQL}
SELECT id, unnest(l) AS segment, generate_subscripts(l, 1) - 1 AS seg_idx
FROM (SELECT id, list_filter(string_split({STRIP_SQL.format(x='title')}, ' '), lambda x: {STRIP_SQL.format(x='x')} <> '') AS l FROM articles)""")
def title_segments_q(spark, sf_dir):
    a = S.articles(spark, sf_dir)
    return a.select("id", F.posexplode(T.title_segments(F.col("title"))).alias("seg_idx", "segment"))


@query("time_format", f"""WITH {S.STREAM_SQL}
SELECT id, strftime(make_timestamp((publishAt + 28800000) * 1000), '%Y年%m月%d日') AS day_cn,
       strftime(make_timestamp((publishAt + 28800000) * 1000), '%Y-%m-%d %H:%M:%S') AS ts_text,
       strftime(make_timestamp((publishAt + 28800000) * 1000), '%Y%m%d') AS day_key
FROM stream""")
def time_format_q(spark, sf_dir):
    s = S.stream(spark, sf_dir)
    return s.select("id", T.standard_date(F.col("publishAt")).alias("day_cn"),
                    T.format_ms(F.col("publishAt"), "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
                    T.format_ms(F.col("publishAt"), "yyyyMMdd").alias("day_key"))


def _pairs_sql(expr: str, pairs) -> str:
    return " OR ".join(f"(contains({expr}, '{a}') AND contains({expr}, '{b}'))" for a, b in pairs)


@query("title_filter", f"""WITH {S.ARTICLES_SQL}
SELECT id, CASE WHEN length({STRIP_SQL.format(x='title')}) = 0 OR {_sql_contains_any('title', LAT_FILTER_TERMS)}
  OR regexp_matches(title, '{LAT_FILTER_DATE}') OR {_pairs_sql('title', LAT_FILTER_PAIRS)} THEN 0 ELSE 1 END AS keep
FROM articles""")
def title_filter_q(spark, sf_dir):
    a = S.articles(spark, sf_dir)
    keep = R.title_filter(F.col("title"), LAT_FILTER_TERMS, LAT_FILTER_PAIRS, LAT_FILTER_DATE)
    return a.select("id", keep.cast("int").alias("keep"))


def _place_seg(c):
    """Stand-in parse for the classifier: capitalised → ns, *tion → st, else n."""
    runs = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("[A-Za-z]+"), 0)
    return F.transform(runs, lambda x: F.struct(
        x.alias("word"),
        F.when(x.rlike("^[A-Z]"), F.lit("ns")).when(x.rlike("tion$"), F.lit("st")).otherwise(F.lit("n")).alias("nature")))


def _marked_sql(words_expr: str) -> str:
    return (f"len(list_filter({words_expr}, lambda w: contains(title, '[' || w || ']') OR contains(title, '【' || w || '】') "
            f"OR contains(title, w || '：') OR contains(title, w || ':'))) > 0")


def _classifier_sql() -> str:
    L = LAT_TITLE_LISTS
    toks = "regexp_extract_all(coalesce(title, ''), '[A-Za-z]+')"
    ns = f"list_filter({toks}, lambda x: regexp_matches(x, '^[A-Z]'))"
    st = f"list_filter({toks}, lambda x: NOT regexp_matches(x, '^[A-Z]') AND regexp_matches(x, 'tion$'))"
    steps = [
        ("abs_neg_string", _sql_contains_any("title", L["abs_neg_strings"]), 0),
        ("neg_entity1", _sql_contains_any("title", L["neg_entities1"]), 0),
        ("special_sign", _sql_contains_any("title", [f"[{w}]" for w in L["special_signs"]]), 0),
        ("pos_entity", _sql_contains_any("title", L["pos_entities"]), 1),
        ("neg_entity", _sql_contains_any("title", L["neg_entities"]), 0),
        ("pos_string", _sql_contains_any("title", L["pos_strings"]), 1),
        ("ns_marked", _marked_sql(ns), 1),
        ("st_hy_marked", _marked_sql(st), 0),
        ("neg_string", _sql_contains_any("title", L["neg_strings"]), 0),
    ]
    keep = "CASE " + " ".join(f"WHEN {c} THEN {v}" for _, c, v in steps) + " ELSE 1 END"
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c, _ in steps) + " ELSE 'default' END"
    return f"WITH {S.ARTICLES_SQL} SELECT id, {keep} AS keep, {rule} AS rule FROM articles"


@query("title_classifier", _classifier_sql())
def title_classifier_q(spark, sf_dir):
    a = S.articles(spark, sf_dir)
    c = R.title_class(F.col("title"), _place_seg(F.col("title")), LAT_TITLE_LISTS)
    return a.select("id", c["keep"].cast("int").alias("keep"), c["rule"].alias("rule"))
