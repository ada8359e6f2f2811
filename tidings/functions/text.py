"""Scalar text functions (column in, column out), all JVM-side built-ins."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..session import DEFAULT_TZ, local_wall_time

# The blanks that str.strip() cuts, U+3000 among them; identical in Java regex and RE2.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def py_strip(c: Column) -> Column:
    """Trim leading/trailing whitespace, Unicode blanks included (like ``str.strip``)."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def strip_tags(c: Column) -> Column:
    """Delete ``<...>`` tags whose body has no ``>``, ``.`` or ``*`` (URLs survive)."""
    return F.regexp_replace(c, "<[^>.*]+>", "")


def remove_tags(c: Column) -> Column:
    """Delete every ``<...>`` tag."""
    return F.regexp_replace(c, "<[^>]+>", "")


_FULL_DIGITS = "".join(chr(0xFF10 + i) for i in range(10))
_HALF_DIGITS = "0123456789"
# General full-width → half-width: U+3000 → space, U+FF01..U+FF5E → minus 0xFEE0.
_FULL_ALL = "　" + "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_HALF_ALL = " " + "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))


def halfwidth_digits(c: Column) -> Column:
    """Full-width digits → ASCII digits (what the paragraph splitter applies)."""
    return F.translate(c, _FULL_DIGITS, _HALF_DIGITS)


def halfwidth(c: Column) -> Column:
    """General full-width → half-width mapping (95 characters)."""
    return F.translate(c, _FULL_ALL, _HALF_ALL)


def split_literal(c: Column, sep: str | Column) -> Column:
    """Split on a literal separator (regex-quoted)."""
    if isinstance(sep, str):
        return F.split(c, re.escape(sep))
    return F.split(c, F.concat(F.lit("\\Q"), sep, F.lit("\\E")))


def dateline_cut(c: Column, features=C.DATELINE_FEATURES) -> Column:
    """Keep the text after the first dateline marker (in list order) whose first
    occurrence starts before ``int(len/2)``; otherwise the text unchanged."""
    out = c
    # Build from the last feature backwards so the first feature has priority.
    for fea in reversed(features):
        idx = F.locate(fea, c) - 1  # 0-based first index, -1 when absent
        hit = (idx >= 0) & (idx < F.floor(F.length(c) / 2))
        out = F.when(hit, F.call_function("substring", c, idx + 1 + len(fea))).otherwise(out)
    return out


def chunk_regex(open_: str, close: str) -> str:
    """Non-greedy chunk between one bracket pair, within a line (only ``\\n`` ends it)."""
    return f"[{re.escape(open_)}]([^\\n]*?)[{re.escape(close)}]"


def chunk_strings(c: Column, pairs=C.CHUNK_PAIRS) -> Column:
    """array<struct<type, chunk>>: every special chunk, grouped by pair in list order."""
    def tag(o):
        return lambda x: F.struct(F.lit(o).alias("type"), x.alias("chunk"))

    parts = [F.transform(F.regexp_extract_all(c, F.lit(chunk_regex(o, e)), 0), tag(o)) for o, e in pairs]
    return F.concat(*parts)


def chunk_offsets(c: Column, pairs=C.CHUNK_PAIRS) -> Column:
    """array<struct<type, chunk, start, end>> with 0-based [start, end) offsets.

    Regex matches of one pair never overlap and never contain the closer, so
    the first occurrence of a match at or after the previous match's end is
    the match itself: offsets come from a fold of ``locate`` over the matches.
    """
    parts = []
    for o, e in pairs:
        ms = F.regexp_extract_all(c, F.lit(chunk_regex(o, e)), 0)
        init = F.struct(F.lit(0).alias("p"),
                        F.array().cast("array<struct<type:string,chunk:string,start:int,end:int>>").alias("out"))

        def make_step(o):
            def step(acc, m):
                return _offset_step(c, o, acc, m)
            return step

        parts.append(F.aggregate(ms, init, make_step(o), lambda acc: acc["out"]))
    return F.concat(*parts)


def _offset_step(c: Column, o: str, acc: Column, m: Column) -> Column:
    start = F.call_function("locate", m, c, acc["p"] + 1) - 1
    end = start + F.length(m)
    item = F.struct(F.lit(o).alias("type"), m.alias("chunk"), start.alias("start"), end.cast("int").alias("end"))
    return F.struct(end.cast("int").alias("p"), F.array_append(acc["out"], item).alias("out"))


def bracket_strip(c: Column, pairs=C.CHUNK_PAIRS, types=C.CLEAN_CHUNK_TYPES) -> Column:
    """Remove every chunk of the cleaning types, chunks found on the text
    *before* removal, each chunk string removed everywhere, in list order."""
    lists = [F.regexp_extract_all(c, F.lit(chunk_regex(o, e)), 0) for o, e in pairs if o in types]
    return F.aggregate(F.concat(*lists), c, lambda acc, x: F.replace(acc, x, F.lit("")))


def semantic_clean(c: Column, features=C.DATELINE_FEATURES, pairs=C.CHUNK_PAIRS, types=C.CLEAN_CHUNK_TYPES) -> Column:
    """Dateline cut, then bracket removal."""
    return bracket_strip(dateline_cut(c, features), pairs, types)


def title_segments(c: Column) -> Column:
    """Title clauses: strip, split at single spaces, pieces without any sign dropped."""
    return F.filter(F.split(py_strip(c), " "), lambda x: F.length(remove_whitespace(x)) > 0)


def remove_whitespace(c: Column) -> Column:
    return F.regexp_replace(c, "(?U)\\s", "")


def sentence_array(c: Column, mark: str = C.SENTENCE_MARK, soft: str = C.SENTENCE_SOFT_MARKS,
                   max_len: int = C.SENTENCE_MAX_LEN, strip_ws: bool = True) -> Column:
    """array<struct<s_idx, sentence>>: soft marks → mark, split, drop pieces outside (0, max_len)."""
    t = F.translate(c, soft, mark * len(soft)) if soft else c
    pieces = F.split(t, re.escape(mark))
    if strip_ws:
        pieces = F.transform(pieces, remove_whitespace)
    indexed = F.transform(pieces, lambda x, i: F.struct(i.alias("s_idx"), x.alias("sentence")))
    return F.filter(indexed, lambda s: (F.length(s["sentence"]) > 0) & (F.length(s["sentence"]) < max_len))


def format_ms(ms: Column, fmt: str, tz: str = DEFAULT_TZ) -> Column:
    """Epoch ms → local wall-clock string (``''`` when NULL)."""
    return F.coalesce(F.date_format(local_wall_time(ms, tz), fmt), F.lit(""))


def standard_date(ms: Column, tz: str = DEFAULT_TZ) -> Column:
    return format_ms(ms, "yyyy年MM月dd日", tz)


def text_of(title: Column, content: Column, sep: str = " ") -> Column:
    return F.concat_ws(sep, F.coalesce(title, F.lit("")), F.coalesce(content, F.lit("")))


def paragraphs(df: DataFrame, id_col: str, content_col: str, source_col: str | None,
               crawl_source: str = "CRAWL", sep_crawl: str = C.PARAGRAPH_SEP_CRAWL,
               sep_other: str = C.PARAGRAPH_SEP_OTHER) -> DataFrame:
    """(id, p_pos, text): digits to half width, split by source, strip tags, drop blank.

    ``p_pos`` is the index of the piece in the split, so order is kept.
    """
    content = halfwidth_digits(F.col(content_col))
    if source_col is None:
        pieces = split_literal(content, sep_other)
    else:
        pieces = F.when(F.col(source_col) == crawl_source, split_literal(content, sep_crawl)) \
                  .otherwise(split_literal(content, sep_other))
    return (
        df.select(F.col(id_col), F.posexplode(pieces).alias("p_pos", "raw"))
        .select(id_col, F.col("p_pos").cast("int").alias("p_pos"), remove_tags(F.col("raw")).alias("text"))
        .where(F.length(py_strip(F.col("text"))) > 0)
    )
