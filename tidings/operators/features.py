"""Token features, keywords and bag-of-words / TF-IDF as long tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C

#: Tokens whose pairs are counted at a time, and pairs in one batch.
_TOKENS_AT_ONCE = 1 << 18
_PAIRS_AT_ONCE = 1 << 17


def _stop_array(stop_words) -> Column:
    return F.array(*[F.lit(w) for w in stop_words]) if stop_words else F.array().cast("array<string>")


def _is_stop(word: Column, stop_words) -> Column:
    """Whether ``word`` is listed: a set lookup (a list in an array would be walked for every token)."""
    return word.isin(list(stop_words)) if stop_words else F.array_contains(_stop_array(()), word)


def keep_word(tok: Column, stop_words) -> Column:
    """v2 word rule: (not a stop word and POS n*) or POS v* (verbs bypass the stop list)."""
    return (tok["nature"].startswith("n") & ~_is_stop(tok["word"], stop_words)) | tok["nature"].startswith("v")


def token_features(df: DataFrame, title_seg: str = "seg_title", content_seg: str = "seg_content",
                   stop_words=(), ner_natures=C.NER_NATURES) -> DataFrame:
    """Adds ``ners`` (content then title entity tokens), ``title_words`` and
    ``words`` (content then title words) as ordered string arrays."""
    natures = list(ner_natures)

    def ners(seg):
        return F.transform(F.filter(F.coalesce(F.col(seg), F.array()), lambda t: t["nature"].isin(natures)),
                           lambda t: t["word"])

    def words(seg):
        return F.transform(F.filter(F.coalesce(F.col(seg), F.array()), lambda t: keep_word(t, stop_words)),
                           lambda t: t["word"])

    return (df.withColumn("ners", F.concat(ners(content_seg), ners(title_seg)))
              .withColumn("title_words", words(title_seg))
              .withColumn("words", F.concat(words(content_seg), F.col("title_words"))))


def token_features_v1(df: DataFrame, title_seg: str = "seg_title", content_seg: str = "seg_content",
                      stop_words=(), entity_list=(), ner_natures=C.NER_NATURES_V1,
                      drop_natures=C.DROP_NATURES_V1) -> DataFrame:
    """v1 features: ners = content tokens in the entity list or with an entity
    POS, then title tokens in the list; words = content tokens neither of a
    dropped POS nor stop words."""
    stop = _stop_array(stop_words)
    ent = _stop_array(entity_list)
    content = F.coalesce(F.col(content_seg), F.array())
    title = F.coalesce(F.col(title_seg), F.array())
    c_ner = F.transform(F.filter(content, lambda t: F.array_contains(ent, t["word"]) | t["nature"].isin(list(ner_natures))),
                        lambda t: t["word"])
    t_ner = F.transform(F.filter(title, lambda t: F.array_contains(ent, t["word"])), lambda t: t["word"])
    words = F.transform(F.filter(content, lambda t: (~t["nature"].isin(list(drop_natures))) & (~F.array_contains(stop, t["word"]))),
                        lambda t: t["word"])
    return df.withColumn("ners", F.concat(c_ner, t_ner)).withColumn("words", words)


def tagged_entities(words: Column, netags: Column) -> Column:
    """F3 (draft features): the tokens whose entity tag is not ``O``, in order."""
    both = F.filter(F.arrays_zip(words.alias("w"), netags.alias("n")), lambda x: x["n"] != "O")
    return F.transform(both, lambda x: x["w"])


def token_offsets(df: DataFrame, id_col: str, seg_col: str) -> DataFrame:
    """(id, idx, word, offset): offset = total length of the preceding words.

    A running sum over the exploded tokens of each document (the window is
    partitioned by document, so its size is bounded by one document).
    """
    toks = df.select(id_col, F.posexplode(F.coalesce(F.col(seg_col), F.array())).alias("idx", "t"))
    w = Window.partitionBy(id_col).orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    return toks.select(id_col, F.col("idx").cast("int").alias("idx"), F.col("t.word").alias("word"),
                       F.coalesce(F.sum(F.length("t.word")).over(w), F.lit(0)).cast("int").alias("offset"))


def cooccur_edges(df: DataFrame, id_col: str, seg_col: str, natures=C.TEXTRANK_NATURES,
                  stop_words=(), span: int = C.TEXTRANK_SPAN, min_len: int = 2) -> DataFrame:
    """(id, w1, w2, weight): TextRank co-occurrence edges.

    A pair is counted for tokens i < j with j - i < span when both pass the
    filter (POS in ``natures``, length >= ``min_len``, not a stop word).  The
    documents are exchanged by id and each one's pairs are counted where it
    lies, so pairs are never exchanged; rows of one id are counted together.
    """
    nat = list(natures)
    ok = lambda t: t["nature"].isin(nat) & (F.length(F.trim(t["word"])) >= min_len) & ~_is_stop(F.lower(t["word"]), stop_words)
    src = df.select(F.col(id_col).alias("id"), F.transform(F.coalesce(F.col(seg_col), F.array()), lambda t: F.when(ok(t), t["word"])).alias("w"))
    id_type = src.schema["id"].dataType.simpleString()

    def counted(ids: pa.Array, words: pa.Array) -> Iterator[pa.RecordBatch]:
        """Pairs of whole ids, some of their rows at a time."""
        same = pc.run_end_encode(pc.dictionary_encode(ids, null_encoding="encode").indices).run_ends.to_numpy()
        ends, u, first = words.offsets.to_numpy(), 0, 0
        while u < len(ids):
            to = max(first, int(np.searchsorted(same, np.searchsorted(ends, ends[u] + _TOKENS_AT_ONCE, "right") - 1, "right")) - 1)
            v = int(same[to])
            yield from _pairs(ids[u:v], same[first:to + 1] - u, words[u:v], span)
            u, first = v, to + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last id, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            batch = pa.RecordBatch.from_arrays([c.chunk(0) for c in table.columns], ["id", "w"])
            ids = batch.column(0)
            last = ids[len(ids) - 1]
            other = ids.is_valid() if not last.is_valid else pc.fill_null(pc.not_equal(ids, last), True)
            begin = len(ids) - int(np.argmax(other.to_numpy(zero_copy_only=False)[::-1])) if pc.any(other).as_py() else 0
            held = batch.slice(begin)
            if begin:
                yield from counted(ids[:begin], batch.column(1)[:begin])
        if held is not None:
            yield from counted(held.column(0), held.column(1))

    return src.repartition("id").sortWithinPartitions("id").mapInArrow(run, f"id {id_type}, w1 string, w2 string, weight long").withColumnRenamed("id", id_col)


def _pairs(ids: pa.Array, ends: np.ndarray, words: pa.Array, span: int) -> Iterator[pa.RecordBatch]:
    """Counted pairs of rows whose ids end at ``ends``; pairs do not reach from one row to the next."""
    begins = words.offsets.to_numpy()
    spelled = words.values.slice(begins[0], begins[-1] - begins[0]).dictionary_encode()
    n, lengths = len(spelled.dictionary), np.diff(begins)
    if not n:
        return
    code = spelled.indices.fill_null(-1).to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(ids)), lengths)
    whose = np.searchsorted(ends, row, "right")
    found = []
    for k in range(1, span):
        i = np.flatnonzero((code[:-k] >= 0) & (code[k:] >= 0) & (row[:-k] == row[k:]))
        found.append((whose[i] * n + code[i]) * n + code[i + k])
    pairs, counts = np.unique(np.concatenate(found), return_counts=True)
    first, b = np.divmod(pairs, n)
    at, a = np.divmod(first, n)
    for u in range(0, len(pairs), _PAIRS_AT_ONCE):
        part = slice(u, u + _PAIRS_AT_ONCE)
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(ends[at[part]] - 1)), spelled.dictionary.take(pa.array(a[part])), spelled.dictionary.take(pa.array(b[part])),
                                          pa.array(counts[part])], ["id", "w1", "w2", "weight"])


def ranked_terms(bag: DataFrame, id_col: str, k: int) -> DataFrame:
    """Top-k terms per document by (count desc, first position) — a
    deterministic keyword ranker usable where TextRank is not wanted."""
    w = Window.partitionBy(id_col).orderBy(F.col("tf").desc(), F.col("first_idx"))
    return bag.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def bag_of_words(df: DataFrame, id_col: str, words_col: str) -> DataFrame:
    """(id, term, tf, first_idx): term counts per document (partial hash aggregate).

    The outer form keeps Spark from inferring a filter on the words, which
    would be pushed down and make them a second time."""
    return (df.select(id_col, F.posexplode_outer(words_col).alias("idx", "term")).where(F.col("idx").isNotNull())
              .groupBy(id_col, "term")
              .agg(F.count("*").alias("tf"), F.min("idx").cast("int").alias("first_idx")))


def keyword_boost(bag: DataFrame, keywords: DataFrame, id_col: str) -> DataFrame:
    """Adds boosted counts: keywords in rank order that occur in the bag are
    appended ``weight`` times, weight starting at the number of keywords and
    dropping by one per hit.  ``keywords`` is (id, rank, term)."""
    nkw = keywords.groupBy(id_col).agg(F.count("*").alias("_k"))
    hits = keywords.join(bag.select(id_col, "term"), [id_col, "term"], "left_semi")
    w = Window.partitionBy(id_col).orderBy("rank")
    boosts = (hits.join(nkw, id_col)
                  .withColumn("_hit_no", F.row_number().over(w) - 1)
                  .select(id_col, "term", (F.col("_k") - F.col("_hit_no")).alias("boost")))
    return (bag.join(boosts, [id_col, "term"], "left")
               .withColumn("tf", F.col("tf") + F.coalesce(F.col("boost"), F.lit(0)))
               .drop("boost"))


def tfidf(bag: DataFrame, id_col: str, eps: float = 1e-12, articles: DataFrame | None = None) -> DataFrame:
    """(id, term, w): tf·log2(N/df), near-zero weights dropped, L2-normalised per document.

    N counts all rows of ``articles``, those with an empty bag too (without
    it, the documents of the bag).  Document frequency is one grouped
    aggregate; N is a scalar subquery, so no driver round trip and no
    single-partition window.
    """
    n_docs = bag.select(F.countDistinct(id_col).alias("n")) if articles is None else articles.select(F.count("*").alias("n"))
    df_ = bag.groupBy("term").agg(F.count("*").alias("df"))
    raw = (bag.join(df_, "term")
              .withColumn("w", F.col("tf") * F.log2(n_docs.scalar() / F.col("df")))
              .where(F.abs(F.col("w")) > eps))
    norms = raw.groupBy(id_col).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))
    return raw.join(norms, id_col).select(id_col, "term", (F.col("w") / F.col("_norm")).alias("w"))
