"""Predicates and classifiers over titles and paragraphs (CASE chains of built-ins)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .text import py_strip


def _contains_any(c: Column, words) -> Column:
    """True when ``c`` contains any of ``words`` (False for an empty list)."""
    words = [w for w in words if w != ""]
    if not words:
        return F.lit(False)
    return c.rlike("|".join(re.escape(w) for w in words))


def title_filter(title: Column, terms=(), pairs=C.TITLE_FILTER_PAIRS,
                 date_regex: str | None = C.TITLE_FILTER_DATE, extra_words=None) -> Column:
    """Keep (True) / reject (False) a title.

    Rejects blank titles, titles containing any custom term, titles matching
    the month-day pattern, and titles holding both words of any pair.  With
    ``extra_words`` the test variant also rejects on any single extra word.
    """
    t = F.coalesce(title, F.lit(""))
    reject = F.length(py_strip(t)) == 0
    terms = [x.strip() for x in terms]
    reject = reject | _contains_any(t, terms)
    if date_regex:
        reject = reject | t.rlike(date_regex)
    for a, b in pairs:
        reject = reject | (F.instr(t, a) > 0) & (F.instr(t, b) > 0)
    if extra_words:
        reject = reject | _contains_any(t, extra_words)
    return ~reject


def _token_marked(title: Column, words: Column, closers) -> Column:
    """Any token w of ``words`` with ``[w]``, ``【w】``, ``w：`` or ``w:`` in the title."""
    def marked(w):
        return (
            (F.instr(title, F.concat(F.lit("["), w, F.lit("]"))) > 0)
            | (F.instr(title, F.concat(F.lit("【"), w, F.lit("】"))) > 0)
            | (F.instr(title, F.concat(w, F.lit("："))) > 0)
            | (F.instr(title, F.concat(w, F.lit(":"))) > 0)
        )
    return F.exists(words, marked)


def title_class(title: Column, seg: Column, lists: dict) -> Column:
    """Ordered title classifier → struct<keep:boolean, rule:string>.

    ``seg`` is array<struct<word, nature>>.  ``lists`` holds seven word lists:
    abs_neg_strings, neg_entities1, special_signs, pos_entities, neg_entities,
    pos_strings, neg_strings.  The first rule that fires decides; the default
    is keep.  Tokens with blank words are ignored.
    """
    t = F.coalesce(title, F.lit(""))
    toks = F.filter(F.coalesce(seg, F.array()), lambda x: F.length(py_strip(x["word"])) > 0)
    ns_words = F.transform(F.filter(toks, lambda x: x["nature"] == "ns"), lambda x: x["word"])
    sthy_words = F.transform(F.filter(toks, lambda x: x["nature"].isin("st", "hy")), lambda x: x["word"])
    special = [f"[{w}]" for w in lists.get("special_signs", ())]
    steps = [
        ("abs_neg_string", _contains_any(t, lists.get("abs_neg_strings", ())), False),
        ("neg_entity1", _contains_any(t, lists.get("neg_entities1", ())), False),
        ("special_sign", _contains_any(t, special), False),
        ("pos_entity", _contains_any(t, lists.get("pos_entities", ())), True),
        ("neg_entity", _contains_any(t, lists.get("neg_entities", ())), False),
        ("pos_string", _contains_any(t, lists.get("pos_strings", ())), True),
        ("ns_marked", _token_marked(t, ns_words, None), True),
        ("st_hy_marked", _token_marked(t, sthy_words, None), False),
        ("neg_string", _contains_any(t, lists.get("neg_strings", ())), False),
    ]
    keep = F.lit(True)
    rule = F.lit("default")
    for name, cond, val in reversed(steps):
        keep = F.when(cond, F.lit(val)).otherwise(keep)
        rule = F.when(cond, F.lit(name)).otherwise(rule)
    return F.struct(keep.alias("keep"), rule.alias("rule"))


def paragraph_kind(p: Column, features=C.DATELINE_FEATURES, date_regex: str = "^[^\\n]*[0-9]日",
                   date_words=C.PARAGRAPH_DATE_WORDS, min_len: int = C.PARAGRAPH_MIN_LEN,
                   max_len: int = C.PARAGRAPH_MAX_LEN) -> Column:
    """'RPT' (dateline feature), 'TMP' (date on the first line or a date word) or ''."""
    n = F.length(p)
    in_range = (n > min_len) & (n < max_len)
    return (
        F.when(~in_range, F.lit(""))
        .when(_contains_any(p, features), F.lit("RPT"))
        .when(p.rlike(date_regex), F.lit("TMP"))
        .when(_contains_any(p, date_words), F.lit("TMP"))
        .otherwise(F.lit(""))
    )


def event_description(paras: DataFrame, id_col: str, kind_col: str = "kind",
                      pos_col: str = "p_pos", text_col: str = "text") -> DataFrame:
    """Per article the first RPT paragraph, else the first TMP one; others dropped.

    ``max_by`` over (kind rank, -pos) is a partial aggregate, so an article
    with very many paragraphs never lands whole in one window task.
    """
    ranked = paras.where(F.col(kind_col) != "").withColumn(
        "_key", F.struct(F.when(F.col(kind_col) == "RPT", 1).otherwise(0).alias("k"), (-F.col(pos_col)).alias("p"))
    )
    best = ranked.groupBy(id_col).agg(F.max_by(F.struct(pos_col, kind_col, text_col), F.col("_key")).alias("b"))
    return best.select(id_col, F.col("b." + pos_col).alias(pos_col), F.col("b." + kind_col).alias(kind_col),
                       F.col("b." + text_col).alias("event_description"))


def top1_by_order(df: DataFrame, keys, order_cols) -> DataFrame:
    """First row per key under a total order (row_number = 1)."""
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
