"""Lexicons and thresholds.

Every operator takes its word lists and limits as parameters.  The
defaults below are the fixed values the news pipeline uses (Chinese
wire-news conventions); the query registry passes Latin stand-ins
because the test tables hold no Chinese text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's for equal results).
# --------------------------------------------------------------------------

# Dateline markers, tried in this order (text after the first early hit is kept).
DATELINE_FEATURES = ("日电", "日讯", "日消息", "日报道")

# Words that make a paragraph an event-time paragraph.
PARAGRAPH_DATE_WORDS = ("日前", "近日")

# Paragraph separators: CRAWL sources, everything else.
PARAGRAPH_SEP_CRAWL = "</p><p>"
PARAGRAPH_SEP_OTHER = "</p></p><p><p>"

# Bracket / quote pairs recognised as special chunks, in priority order.
CHUNK_PAIRS = (
    ("(", ")"), ("（", "）"), ("<", ">"), ("《", "》"), ("【", "】"), ("[", "]"),
    ("{", "}"), ("「", "」"), ("‘", "’"), ('"', '"'), ("“", "”"), ("'", "'"),
)
# Opening signs whose chunks are deleted by the semantic cleaner.
CLEAN_CHUNK_TYPES = ("(", "（", "【", "[", "<")

# POS tags of named entities (v2 features) and of v1 entity-like tokens.
NER_NATURES = ("ni", "ns", "nh", "nz")
NER_NATURES_V1 = ("hy", "st", "nr", "nto", "nis", "ns", "nz", "nt")
# POS tags dropped from v1 words.
DROP_NATURES_V1 = ("w", "t", "f", "m", "c", "cc", "d")
# POS tags kept by the TextRank keyword extractor.
TEXTRANK_NATURES = ("n", "nr", "ns", "nt", "nz", "nrt", "j", "v", "vn")

# Title filter: the title is rejected when it holds both words of any pair.
TITLE_FILTER_PAIRS = (
    ("同比", "净利"), ("同比", "利润"), ("同比", "产量"), ("同比", "增长"),
    ("营收", "净利"), ("快讯", "报于"), ("目标价", "评级"), ("买入", "评级"),
    ("增持", "评级"), ("维持", "评级"), ("质押", "万股票"), ("本周国内", "价格"),
    ("营收", "净赚"), ("质押", "股"),
)
TITLE_FILTER_DATE = "([0-9]*)月([0-9]*)日"
# Extra single-word rule of the test variant (利润 / 减 / 增 / 涨 alone reject).
TITLE_FILTER_EXTRA_WORDS = ("利润", "减", "增", "涨")

# Sentence splitting: these map to the sentence mark, then split on it.
SENTENCE_MARK = "。"
SENTENCE_SOFT_MARKS = "；，"
SENTENCE_MAX_LEN = 500

# Report-time types that follow a dateline date.
RPT_TYPES = ("报道", "消息", "讯", "获悉", "公布", "电", "号")
# Range separators between two dates.
RANGE_SEPS = ("-", "到", "至", "—", "和", "－")

# Thresholds.
PARAGRAPH_MIN_LEN = 20          # exclusive
PARAGRAPH_MAX_LEN = 500         # exclusive
MIN_BATCH = 100
CENTROID_THRESHOLD = 0.7
TWO_THRESHOLD_WORD = 0.8
TWO_THRESHOLD_NER = 0.35
TWO_THRESHOLD_WORD_ALONE = 0.9
EVENT_MATCH_THRESHOLD = 0.66
MERGE_MIN_SIZE = 3              # clusters merge only when size > 3
TEXTRANK_TOPK = 20
TEXTRANK_SPAN = 5
TEXTRANK_DAMPING = 0.85
TEXTRANK_ITERATIONS = 10
LSI_TOPICS = 500
KEYWORDS_TOPK = 5

# Merge predicate: (title fraction, content fraction) pairs tried in order;
# None means "no test on this list".
MERGE_RULES = ((0.6, None), (None, 0.8), (0.4, 0.5), (0.2, 0.6))


@dataclass(frozen=True)
class Config:
    """Word lists and limits handed to the operators."""

    stop_words: tuple[str, ...] = ()
    dateline_features: tuple[str, ...] = DATELINE_FEATURES
    paragraph_date_words: tuple[str, ...] = PARAGRAPH_DATE_WORDS
    paragraph_date_regex: str = "^[^\\n]*[0-9]日"
    paragraph_sep_crawl: str = PARAGRAPH_SEP_CRAWL
    paragraph_sep_other: str = PARAGRAPH_SEP_OTHER
    crawl_source: str = "CRAWL"
    paragraph_features: tuple[str, ...] = DATELINE_FEATURES
    chunk_pairs: tuple[tuple[str, str], ...] = CHUNK_PAIRS
    merge_chunk_pairs: tuple[tuple[str, str], ...] = CHUNK_PAIRS
    clean_chunk_types: tuple[str, ...] = CLEAN_CHUNK_TYPES
    ner_natures: tuple[str, ...] = NER_NATURES
    title_filter_terms: tuple[str, ...] = ()
    title_filter_pairs: tuple[tuple[str, str], ...] = TITLE_FILTER_PAIRS
    title_filter_date: str = TITLE_FILTER_DATE
    title_filter_extra: bool = False
    sentence_mark: str = SENTENCE_MARK
    sentence_soft_marks: str = SENTENCE_SOFT_MARKS
    sentence_strip_ws: bool = True
    title_lists: dict = field(default_factory=dict)
