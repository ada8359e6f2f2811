"""Annotation queries (X1–X7) over a stand-in parse of document sentences.

Stand-in parse of each '.'-sentence (tokens = letter runs, POS as in
``standins.seg``): the root is the first verb (else token 0); a token
just before the root is its SBV, earlier ones are ATT of their right
neighbour; the token just after the root is its VOB, later verbs are COO of
the root, other later tokens ATT of their left neighbour.  Entity tags:
capitalised runs are ``S-Nh`` (≤ 5 letters) or ``S-Ni``, others ``O``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from .. import config as C
from ..operators import annotate as A
from ..operators import articles as AR
from ..session import stored
from . import catalog_text as CT
from . import standins as S
from .registry import query

KEYS = ["doc_id", "s_idx"]


def parse(s, raw=None):
    """The stand-in parse: arcs and entity tags for words and postags of a sentence (``raw``: its letter runs, if known)."""
    raw = F.regexp_extract_all("sentence", F.lit("[A-Za-z]+"), 0) if raw is None else raw
    s = (s.withColumn("_vpos", F.array_position("postags", "v"))
          .withColumn("_root", F.when(F.col("_vpos") > 0, F.col("_vpos") - 1).otherwise(0).cast("int")))
    r = F.col("_root")

    def arc(p, i):
        head = (F.when(i == r, 0)
                 .when(i < r, F.when(i == r - 1, r + 1).otherwise(i + 2))
                 .otherwise(F.when(i == r + 1, r + 1).when(p == "v", r + 1).otherwise(i)))
        rel = (F.when(i == r, "HED")
                .when(i < r, F.when(i == r - 1, "SBV").otherwise("ATT"))
                .otherwise(F.when(i == r + 1, "VOB").when(p == "v", "COO").otherwise("ATT")))
        return F.struct(head.cast("int").alias("head"), rel.alias("rel"))

    return s.withColumn("arcs", F.transform("postags", arc)).withColumn(
        "netags", F.transform(raw, lambda x: F.when(S.upper_first(x), F.when(F.length(x) <= 5, "S-Nh").otherwise("S-Ni"))
                                              .otherwise("O"))).drop("_vpos", "_root")


def parsed(spark, sf_dir, by_sentence=False):
    """Parsed sentences; ``by_sentence`` exchanges them by sentence first, for queries that group their tokens."""
    d = S.table(spark, sf_dir, "documents")
    told = F.filter(F.transform(F.split("text", "\\."), lambda x, i: F.struct(
        i.cast("int").alias("s_idx"), F.regexp_extract_all(x, F.lit("[A-Za-z]+"), 0).alias("raw"))), lambda x: F.size(x["raw"]) > 0)
    s = d.select("doc_id", F.explode_outer(told).alias("x")).where(F.col("x").isNotNull())
    s = s.select("doc_id", "x.s_idx", "x.raw")
    if by_sentence:
        # One string for each sentence travels; what is grouped by sentence afterwards stays where it is.
        s = s.select(*KEYS, F.array_join("raw", " ").alias("runs")).repartition(*KEYS).select(*KEYS, F.split("runs", " ").alias("raw"))
    s = parse(s.withColumn("words", F.transform("raw", F.lower)).withColumn("postags", F.transform("raw", S.nature)), F.col("raw"))
    return s.select(*KEYS, "words", "postags", "arcs", "netags")


PARSE_SQL = f"""sent AS (
  SELECT doc_id, unnest(l) AS sentence, generate_subscripts(l, 1) - 1 AS s_idx
  FROM (SELECT doc_id, string_split(text, '.') AS l FROM documents)),
seg AS (SELECT doc_id, s_idx, {S.seg_sql('sentence')} AS sg, regexp_extract_all(sentence, '[A-Za-z]+') AS raw FROM sent),
p0 AS (SELECT doc_id, s_idx, raw, list_transform(sg, lambda t: t.word) AS words, list_transform(sg, lambda t: t.nature) AS postags
       FROM seg WHERE len(sg) > 0),
p1 AS (SELECT *, CASE WHEN list_position(postags, 'v') > 0 THEN list_position(postags, 'v') - 1 ELSE 0 END AS r FROM p0),
tok AS (
  SELECT doc_id, s_idx, r, unnest(words) AS word, unnest(postags) AS postag, unnest(raw) AS rw,
         generate_subscripts(words, 1) - 1 AS idx FROM p1),
arcs AS (
  SELECT doc_id, s_idx, idx, word, postag,
         CASE WHEN idx = r THEN 0 WHEN idx < r THEN (CASE WHEN idx = r - 1 THEN r + 1 ELSE idx + 2 END)
              ELSE (CASE WHEN idx = r + 1 THEN r + 1 WHEN postag = 'v' THEN r + 1 ELSE idx END) END AS head,
         CASE WHEN idx = r THEN 'HED' WHEN idx < r THEN (CASE WHEN idx = r - 1 THEN 'SBV' ELSE 'ATT' END)
              ELSE (CASE WHEN idx = r + 1 THEN 'VOB' WHEN postag = 'v' THEN 'COO' ELSE 'ATT' END) END AS rel,
         CASE WHEN regexp_matches(rw, '^[A-Z]') THEN (CASE WHEN length(rw) <= 5 THEN 'Nh' ELSE 'Ni' END) END AS ntype
  FROM tok)"""

ISLANDS_SQL = """,
isl AS (
  SELECT *, sum(CASE WHEN ntype IS NOT NULL AND (prev IS NULL OR prev <> ntype) THEN 1 ELSE 0 END)
            OVER (PARTITION BY doc_id, s_idx ORDER BY idx) AS g
  FROM (SELECT *, lag(ntype) OVER (PARTITION BY doc_id, s_idx ORDER BY idx) AS prev FROM arcs)),
chunks AS (
  SELECT doc_id, s_idx, any_value(ntype) AS type, min(idx) AS start, max(idx) + 1 AS "end",
         string_agg(word, '' ORDER BY idx) AS name
  FROM isl WHERE ntype IS NOT NULL GROUP BY doc_id, s_idx, g)"""


@query("child_map", f"""WITH {PARSE_SQL}
SELECT doc_id, s_idx, head - 1 AS parent, rel, array_to_string(list(idx ORDER BY idx), ',') AS children
FROM arcs GROUP BY 1, 2, 3, 4""")
def child_map_q(spark, sf_dir):
    c = A.child_map(parsed(spark, sf_dir, by_sentence=True), KEYS)
    return c.select(*KEYS, "parent", "rel", F.array_join("children", ",").alias("children"))


@query("ner_islands", f"""WITH {PARSE_SQL}{ISLANDS_SQL}
SELECT doc_id, s_idx, type, start, "end", name FROM chunks""")
def ner_islands_q(spark, sf_dir):
    return A.ner_islands(parsed(spark, sf_dir, by_sentence=True), KEYS).select(*KEYS, "type", "start", "end", "name")


@query("coarse_tokens", f"""WITH {PARSE_SQL}{ISLANDS_SQL},
has AS (SELECT DISTINCT doc_id, s_idx FROM chunks),
plain AS (
  SELECT a.doc_id, a.s_idx, a.idx AS pos, a.word, a.postag AS nature FROM arcs a JOIN has USING (doc_id, s_idx)
  WHERE NOT EXISTS (SELECT 1 FROM chunks c WHERE c.doc_id = a.doc_id AND c.s_idx = a.s_idx
                    AND a.idx >= c.start AND a.idx < c."end"))
SELECT * FROM plain
UNION ALL SELECT doc_id, s_idx, start AS pos, name AS word, lower(type) AS nature FROM chunks""")
def coarse_tokens_q(spark, sf_dir):
    return A.coarse_tokens(parsed(spark, sf_dir, by_sentence=True), KEYS).select(*KEYS, "pos", "word", "nature")


@query("core_words", f"""WITH RECURSIVE {PARSE_SQL},
offs AS (SELECT doc_id, s_idx, idx, word, CAST(coalesce(sum(length(word)) OVER (PARTITION BY doc_id, s_idx ORDER BY idx
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS offe FROM arcs),
reach(doc_id, s_idx, idx, depth) AS (
  SELECT doc_id, s_idx, idx, 0 FROM arcs WHERE rel = 'HED'
  UNION ALL
  SELECT a.doc_id, a.s_idx, a.idx, r.depth + 1 FROM reach r
  JOIN arcs a ON a.doc_id = r.doc_id AND a.s_idx = r.s_idx AND a.head - 1 = r.idx AND a.rel = 'COO')
SELECT r.doc_id, r.s_idx, r.idx, o.word, o.offe, r.depth FROM reach r JOIN offs o USING (doc_id, s_idx, idx)""")
def core_words_q(spark, sf_dir):
    return A.core_words(parsed(spark, sf_dir), KEYS).select(*KEYS, "idx", "word", "offe", "depth")


@query("triples", f"""WITH {PARSE_SQL},
root AS (SELECT doc_id, s_idx, r, words, postags, len(words) AS n FROM p1 WHERE postags[r + 1] = 'v'),
run AS (SELECT t.doc_id, t.s_idx, string_agg(t.word, '' ORDER BY t.idx DESC) AS obj
        FROM tok t WHERE t.idx > t.r AND NOT EXISTS (
          SELECT 1 FROM tok u WHERE u.doc_id = t.doc_id AND u.s_idx = t.s_idx AND u.postag = 'v'
          AND u.idx > u.r + 1 AND u.idx <= t.idx) GROUP BY 1, 2)
SELECT q.doc_id, q.s_idx, CAST(0 AS INTEGER) AS k, array_to_string(q.words[1:q.r], '') AS sub, q.words[q.r + 1] AS verb,
       coalesce(run.obj, '') AS obj,
       CASE WHEN q.r > 0 AND q.r + 1 < q.n THEN '主谓宾' WHEN q.r > 0 THEN '主谓' ELSE '谓宾' END AS type, true AS core
FROM root q LEFT JOIN run USING (doc_id, s_idx) WHERE q.n > 1""")
def triples_q(spark, sf_dir):
    """subject–verb–object triples per sentence.  In the stand-in
    parse only the root has a subject or object, so the oracle is a closed
    form; the other rules are held by goldens on hand-written parses."""
    return A.triples(parsed(spark, sf_dir), KEYS)


def _stand_in_roles(sents):
    """Stand-in role labels: for every verb p, A0 = tokens [p-2, p-1] and
    A1 = [p+1, p+2], clipped to the sentence (no TMP / LOC roles)."""
    t = A.exploded_arcs(sents, KEYS)
    n = sents.select(*KEYS, F.size("words").alias("n"))
    v = t.where(F.col("postag") == "v").select(*KEYS, F.col("idx").alias("pred")).join(n, KEYS)
    a0 = v.where(F.col("pred") > 0).select(*KEYS, "pred", F.lit("A0").alias("role"),
                                             F.greatest(F.col("pred") - 2, F.lit(0)).alias("start"), (F.col("pred") - 1).alias("end"))
    a1 = v.where(F.col("pred") < F.col("n") - 1).select(*KEYS, "pred", F.lit("A1").alias("role"), (F.col("pred") + 1).alias("start"),
                                                        F.least(F.col("pred") + 2, F.col("n") - 1).alias("end"))
    return a0.unionByName(a1)


@query("role_triples", f"""WITH {PARSE_SQL},
v AS (SELECT a.doc_id, a.s_idx, a.idx AS pred, a.word AS verb, m.n FROM arcs a
      JOIN (SELECT doc_id, s_idx, count(*) AS n FROM arcs GROUP BY 1, 2) m USING (doc_id, s_idx) WHERE a.postag = 'v'),
r AS (SELECT doc_id, s_idx, pred, 'A0' AS role, greatest(pred - 2, 0) AS start, pred - 1 AS "end" FROM v WHERE pred > 0
      UNION ALL SELECT doc_id, s_idx, pred, 'A1', pred + 1, least(pred + 2, n - 1) FROM v WHERE pred < n - 1),
sp AS (SELECT r.doc_id, r.s_idx, r.pred, r.role, string_agg(a.word, '' ORDER BY a.idx) AS text
       FROM r JOIN arcs a ON a.doc_id = r.doc_id AND a.s_idx = r.s_idx AND a.idx BETWEEN r.start AND r."end"
       GROUP BY 1, 2, 3, 4)
SELECT v.doc_id, v.s_idx, v.pred, coalesce(s0.text, '') AS sub, v.verb, coalesce(s1.text, '') AS obj,
       CAST(NULL AS VARCHAR) AS tmp, CAST(NULL AS VARCHAR) AS loc
FROM v LEFT JOIN sp s0 ON s0.doc_id = v.doc_id AND s0.s_idx = v.s_idx AND s0.pred = v.pred AND s0.role = 'A0'
       LEFT JOIN sp s1 ON s1.doc_id = v.doc_id AND s1.s_idx = v.s_idx AND s1.pred = v.pred AND s1.role = 'A1'
WHERE v.n > 1""")
def role_triples_q(spark, sf_dir):
    s = stored(parsed(spark, sf_dir))
    return A.role_triples(_stand_in_roles(s), s, KEYS)


def _offsets(words: pa.Array) -> pa.Array:
    """Length of the words before each word of a sentence."""
    lengths = pc.utf8_length(words.values).fill_null(0).to_numpy().astype(np.int64)
    before, ends = np.concatenate([[0], np.cumsum(lengths)]), words.offsets.to_numpy()
    flat = np.zeros(len(lengths), np.int64)
    flat[ends[0]:ends[-1]] = before[ends[0]:ends[-1]] - np.repeat(before[ends[:-1]], np.diff(ends))
    out = pa.ListArray.from_arrays(words.offsets, pa.array(flat.astype(np.int32)))
    return pc.if_else(words.is_valid(), out, None)


def _sentences(d):
    """(doc_id, s_idx, sentence, words): '.'-sentences with tokens that cover them (letter runs or single other chars).

    Of sentences that share a key every one has the tokens of all, by their
    place; documents without id have none.  Texts are exchanged, not tokens.
    """
    told = d.where(F.col("doc_id").isNotNull()).select("doc_id", "text").repartition("doc_id").groupBy("doc_id").agg(F.collect_list("text").alias("texts"))
    split = told.select("doc_id", F.transform("texts", lambda t: F.split(t, "\\.")).alias("all"))
    s = split.select("doc_id", F.explode_outer(F.flatten(F.transform("all", lambda own: F.transform(own, lambda x, i: F.struct(
        i.cast("int").alias("s_idx"), x.alias("sentence"),
        F.when(F.size("all") > 1, F.filter(F.transform("all", lambda o: F.get(o, i)), lambda y: y.isNotNull())).alias("copies")))))).alias("x"))
    tokens = lambda t: F.regexp_extract_all(t, F.lit("[A-Za-z]+|[^A-Za-z]"), 0)
    by_place = F.transform(F.array_sort(F.flatten(F.transform("copies", lambda c: F.transform(tokens(c), lambda w, i: F.struct(i.alias("i"), w.alias("w")))))),
                           lambda y: y["w"])
    return (s.where(F.col("x").isNotNull()).select("doc_id", "x.*")
            .select("doc_id", "s_idx", "sentence", F.when(F.size("copies") > 1, by_place).otherwise(tokens(F.col("sentence"))).alias("words")))


@query("chunk_token_merge")
def chunk_token_merge_q(spark, sf_dir):
    """sentence tokens with bracket / quote chunks merged into one token
    (fold per sentence; checked against the sequential rule in tests)."""
    from ..functions.text import chunk_offsets
    s = _sentences(S.table(spark, sf_dir, "documents"))
    offsets = F.arrow_udf(_offsets, "array<int>")  # here, as making it needs a session
    s = s.select("doc_id", "s_idx", "words", offsets("words").alias("offsets"), F.transform(chunk_offsets(F.col("sentence")), lambda c: F.struct(
        c["chunk"].alias("chunk"), c["start"].alias("start"), c["end"].alias("end"))).alias("ch"))
    seg = F.zip_with("words", "offsets", lambda w, at: F.struct(
        w.alias("word"), F.when(w.rlike("^[A-Za-z]"), F.lit("n")).otherwise(F.lit("w")).alias("nature"), at.alias("offset")))
    s = s.select("doc_id", "s_idx", seg.alias("seg"), "ch")
    m = s.select("doc_id", "s_idx", A.merge_chunk_tokens(F.col("seg"), F.col("ch")).alias("toks"))
    m = m.select("doc_id", "s_idx", F.posexplode_outer("toks").alias("k", "t")).where(F.col("k").isNotNull())
    return m.select("doc_id", "s_idx", "k", "t.word", "t.nature", "t.offset")


# ---- whole articles (X9): pages as articles, every paragraph rule with Latin words ----------

PAGE_RULES = C.Config(paragraph_features=CT.LAT_RPT, paragraph_date_regex=CT.LAT_TMP_REGEX, paragraph_date_words=CT.LAT_DATE_WORDS,
                      dateline_features=CT.LAT_DATELINE, merge_chunk_pairs=(), sentence_mark=".", sentence_soft_marks=";,", sentence_strip_ws=False)


def page_articles(spark, sf_dir):
    return CT.pages(spark, sf_dir).withColumn("title", F.lit("Two words")).withColumn("publishAt", F.lit(S.BASE_MS) + F.col("id") * 60000)


def annotated_pages(spark, sf_dir):
    return AR.annotate(page_articles(spark, sf_dir), lambda d: d.withColumn("seg", S.seg(F.col("sentence"))), parse, PAGE_RULES)


DESCRIBED_SQL = f"""{CT.PARAS_SQL},
kinds AS (SELECT id, p_pos, text, {CT.KIND_SQL} AS kind FROM paras),
told AS (
  SELECT id, text FROM (SELECT id, text, row_number() OVER (PARTITION BY id ORDER BY CASE WHEN kind = 'RPT' THEN 0 ELSE 1 END, p_pos) AS rn
                        FROM kinds WHERE kind <> '') WHERE rn = 1),
cleaned AS (SELECT id, {CT._clean_sql('c')} AS text FROM (SELECT id, {CT._dateline_sql('text', CT.LAT_DATELINE)} AS c FROM told)),
sent AS (
  SELECT id AS doc_id, sentence, s_idx, row_number() OVER (PARTITION BY id ORDER BY s_idx) - 1 AS at FROM (
    SELECT id, unnest(l) AS sentence, generate_subscripts(l, 1) - 1 AS s_idx
    FROM (SELECT id, string_split(translate(text, ';,', '..'), '.') AS l FROM cleaned))
  WHERE length(sentence) > 0 AND length(sentence) < 500)"""


@query("annotate", f"""WITH {DESCRIBED_SQL},
{PARSE_SQL[PARSE_SQL.index("seg AS ("):]}{ISLANDS_SQL},
root AS (SELECT doc_id, s_idx, r, words, len(words) AS n FROM p1 WHERE postags[r + 1] = 'v'),
run AS (SELECT t.doc_id, t.s_idx, string_agg(t.word, '' ORDER BY t.idx DESC) AS obj
        FROM tok t WHERE t.idx > t.r AND NOT EXISTS (
          SELECT 1 FROM tok u WHERE u.doc_id = t.doc_id AND u.s_idx = t.s_idx AND u.postag = 'v'
          AND u.idx > u.r + 1 AND u.idx <= t.idx) GROUP BY 1, 2),
names AS (SELECT doc_id, s_idx, string_agg(name, ' ' ORDER BY start) AS ners FROM chunks GROUP BY 1, 2),
times AS (SELECT page_id AS doc_id, {S.BASE_MS} + page_id * 60000 AS ms FROM pages)
SELECT s.doc_id AS id, s.at, s.sentence,
       array_to_string(q.words[1:q.r], '') AS sub, q.words[q.r + 1] AS verb, coalesce(run.obj, '') AS obj,
       coalesce(names.ners, '') AS ners, times.ms AS tmp_ms, times.ms AS rpt_ms
FROM sent s JOIN root q USING (doc_id, s_idx) JOIN times USING (doc_id)
LEFT JOIN run USING (doc_id, s_idx) LEFT JOIN names USING (doc_id, s_idx) WHERE q.n > 1""")
def annotate_q(spark, sf_dir):
    """Pages read as articles in one pass, then the triples of their descriptions with core verbs."""
    rows = AR.triple_rows(annotated_pages(spark, sf_dir)).where("core")
    return rows.select("id", "at", "sentence", "sub", "verb", "obj", F.array_join("ners", " ").alias("ners"), "tmp_ms", "rpt_ms")
