"""From raw articles to annotated ones (X9, data event processing): description, times, sentences, triples, entities.

One row-local pass: the paragraph that reports the event (P3, P4), report and
event time (D1–D6), title clauses (T8), the cleaned description's sentences
(T5, T6, T10), tokens with special chunks fused (T7, F4), triples with core
words (X2–X5), entity chunks (X6) and each sentence's time (D7) are array and
column functions inside the article's or the sentence's row.  The only shuffle
packs the sentences back under their article, in order.

Segmenter and parser are models of the caller: ``segment`` adds ``seg``
(array<struct<word, nature, offset>>) for the column ``sentence``, ``parse``
adds ``arcs`` and ``netags`` for ``words`` and ``postags``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import dates as D
from ..functions import rules as R
from ..functions import text as T
from ..session import DEFAULT_TZ, cut_lineage
from . import annotate as A

Step = Callable[[DataFrame], DataFrame]

#: Parts of an article, in the order in which its triples are read.
TITLE, CONTENT = 0, 1


def description(content: Column, source: Column, rules: C.Config = C.Config()) -> Column:
    """P3 / P4 inside the row: the first paragraph with a dateline, else the first with a date; null when there is none."""
    digits = T.halfwidth_digits(content)
    pieces = F.when(source == rules.crawl_source, T.split_literal(digits, rules.paragraph_sep_crawl)).otherwise(
        T.split_literal(digits, rules.paragraph_sep_other))
    texts = F.filter(F.transform(pieces, T.remove_tags), lambda p: F.length(T.py_strip(p)) > 0)
    kinds = F.transform(texts, lambda p: F.struct(R.paragraph_kind(
        p, rules.paragraph_features, rules.paragraph_date_regex, rules.paragraph_date_words).alias("kind"), p.alias("text")))
    first = lambda kind: F.try_element_at(F.filter(kinds, lambda p: p["kind"] == kind), F.lit(1))["text"]
    return F.coalesce(first("RPT"), first("TMP"))


def entity_chunks(words: Column, netags: Column) -> Column:
    """X6 inside the row: array<struct<type, start, end, name>> of the maximal runs of one entity type."""
    types = F.transform(netags, lambda t: F.when(t != "O", F.element_at(F.split(t, "-"), -1)))
    # Places where a run begins or ends; a run reaches to the next of them.
    edges = F.concat(F.filter(F.transform(types, lambda t, i: F.when((i == 0) | ~t.eqNullSafe(F.get(types, i - 1)), i)), lambda i: i.isNotNull()),
                     F.array(F.size(types)))
    runs = F.transform(edges, lambda s, k: F.struct(F.get(types, s).alias("type"), s.alias("start"), F.get(edges, k + 1).alias("end")))
    return F.transform(F.filter(runs, lambda r: r["type"].isNotNull()), lambda r: F.struct(
        r["type"].alias("type"), r["start"].alias("start"), r["end"].alias("end"),
        F.array_join(F.slice(words, r["start"] + 1, r["end"] - r["start"]), "").alias("name")))


def annotate(articles: DataFrame, segment: Step, parse: Step, rules: C.Config = C.Config(), title_rule: Callable[[Column], Column] | None = None,
             right_len: bool = False, tz: str = DEFAULT_TZ) -> DataFrame:
    """Articles (id, title, content, dataSource, publishAt, ...) that describe an event, with what is read from them.

    Adds event_description, rpt_ms, tmp_ms (D6; null when only a report time
    is found), and titles_info and sentences_info: arrays of struct<sentence,
    words, triples, core, ners, tmp_ms, rpt_ms> in order; ``content`` becomes
    the cleaned description.  Articles without title, content or describing
    paragraph are left out, and those that ``title_rule`` rejects (P8: none by
    default).  ``id`` is unique; null times stay null.
    """
    kept = articles.where(F.col("title").isNotNull() & F.col("content").isNotNull())
    if title_rule is not None:
        kept = kept.where(title_rule(F.col("title")))
    told = kept.withColumn("event_description", description(F.col("content"), F.col("dataSource"), rules)).where(F.col("event_description").isNotNull())
    timed = D.with_sentence_times(told, "event_description", "publishAt", tz, out="_times")
    article = D.article_times(F.col("_times.rpt_ms"), F.col("_times.tmp_ms"), F.col("publishAt"))
    # Read twice: for the sentences and for the articles they are packed under.
    whole = cut_lineage(timed.withColumn("_article", article).withColumn("rpt_ms", F.col("_article.rpt_ms")).withColumn("tmp_ms", F.col("_article.tmp_ms"))
                        .withColumn("content", T.semantic_clean(F.col("event_description"), rules.dateline_features, rules.chunk_pairs, rules.clean_chunk_types))
                        .drop("_times", "_article"))
    titles = F.transform(T.title_segments(F.col("title")), lambda x, i: F.struct(F.lit(TITLE).alias("part"), i.alias("at"), T.remove_whitespace(x).alias("sentence")))
    sentences = F.transform(T.sentence_array(F.col("content"), rules.sentence_mark, rules.sentence_soft_marks, strip_ws=rules.sentence_strip_ws),
                            lambda s: F.struct(F.lit(CONTENT).alias("part"), s["s_idx"].alias("at"), s["sentence"].alias("sentence")))
    rows = (whole.select("id", "publishAt", "rpt_ms", F.col("tmp_ms").alias("_article_tmp"), F.explode(F.concat(titles, sentences)).alias("p"))
            .select("id", "publishAt", "rpt_ms", "_article_tmp", "p.part", "p.at", "p.sentence").where(F.length("sentence") > 0))
    seg = segment(D.with_sentence_times(rows, "sentence", "publishAt", tz, out="_own"))
    if rules.merge_chunk_pairs:
        chunks = F.transform(T.chunk_offsets(F.col("sentence"), rules.merge_chunk_pairs),
                             lambda c: F.struct(c["chunk"].alias("chunk"), c["start"].alias("start"), c["end"].alias("end")))
        seg = seg.withColumn("seg", A.merge_chunk_tokens(F.col("seg"), chunks))
    tokens = seg.withColumn("words", F.transform("seg", lambda t: t["word"])).withColumn("postags", F.transform("seg", lambda t: t["nature"]))
    parsed = parse(tokens).withColumn("ners", entity_chunks(F.col("words"), F.col("netags")))
    time = F.when(F.col("part") == TITLE, F.col("_article_tmp")).otherwise(D.sentence_tmp(F.col("_own"), F.col("_article_tmp")))
    parsed = parsed.withColumn("_tmp", time)
    read = A.read_sentences(parsed, ["id", "part", "at", "sentence", "ners", "_tmp", "rpt_ms"], right_len)
    info = F.struct("part", "at", F.struct("sentence", "words", "triples", "core", "ners", F.col("_tmp").alias("tmp_ms"), "rpt_ms").alias("info"))
    packed = read.groupBy(F.col("id").alias("_id")).agg(F.array_sort(F.collect_list(info)).alias("_parts"))

    def of(part: int) -> Column:
        found = F.filter("_parts", lambda x: x["part"] == part)
        return F.coalesce(F.transform(found, lambda x: x["info"]), F.transform(F.filter(found, lambda x: F.lit(False)), lambda x: x["info"]))

    return (whole.join(packed, F.col("id") == F.col("_id"), "left").withColumn("titles_info", of(TITLE)).withColumn("sentences_info", of(CONTENT))
            .drop("_id", "_parts"))


def triple_rows(annotated: DataFrame, *keys: str) -> DataFrame:
    """(keys…, id, part, at, k, sentence, sub, verb, obj, type, core, ners, tmp_ms, rpt_ms): triples, titles before sentences, in order."""
    tagged = lambda col, part: F.transform(col, lambda x, i: F.struct(F.lit(part).alias("part"), i.alias("at"), x.alias("x")))
    empty = F.filter(tagged("sentences_info", CONTENT), lambda x: F.lit(False))
    both = F.concat(F.coalesce(tagged("titles_info", TITLE), empty), F.coalesce(tagged("sentences_info", CONTENT), empty))
    rows = annotated.select(*keys, "id", F.explode(both).alias("p")).select(*keys, "id", "p.part", "p.at", "p.x.*")
    core = F.array_contains(F.transform("core", lambda c: c["word"]), F.col("t.verb"))
    return (rows.select(*keys, "id", "part", "at", "sentence", "core", "ners", "tmp_ms", "rpt_ms", F.posexplode("triples").alias("k", "t"))
            .select(*keys, "id", "part", "at", "k", "sentence", "t.sub", "t.verb", "t.obj", "t.type", core.alias("core"),
                    F.transform("ners", lambda n: n["name"]).alias("ners"), "tmp_ms", "rpt_ms"))
