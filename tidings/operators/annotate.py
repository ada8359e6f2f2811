"""Annotation operators over parsed sentences.

Input: one row per sentence with parallel arrays ``words``, ``postags``,
``netags`` and ``arcs`` (array<struct<head:int, rel:string>>, 1-based head,
0 = root).  Work is either a grouped aggregate over the exploded arcs (child
map, islands) or stays inside the sentence row, so no step needs a join: core
words follow chains of arcs by pointer doubling, triples are read by a Python
function that is linear in the tokens.
"""

from __future__ import annotations

import json
from heapq import heappop, heappush
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def exploded_arcs(sents: DataFrame, keys) -> DataFrame:
    """(keys…, idx, word, postag, head, rel): one row per token (idx 0-based)."""
    k = list(keys)
    z = F.arrays_zip(F.col("words").alias("w"), F.col("postags").alias("p"), F.col("arcs").alias("a"))
    return (sents.select(*k, F.posexplode_outer(z).alias("idx", "t")).where(F.col("idx").isNotNull())
                 .select(*k, F.col("idx").cast("int").alias("idx"), F.col("t.w").alias("word"),
                         F.col("t.p").alias("postag"), F.col("t.a.head").alias("head"), F.col("t.a.rel").alias("rel")))


def child_map(sents: DataFrame, keys) -> DataFrame:
    """(keys…, parent, rel, children) — children of each (parent, relation)
    in index order; parent is 0-based (-1 = the virtual root)."""
    k = list(keys)
    a = (sents.select(*k, F.posexplode_outer("arcs").alias("idx", "a")).where(F.col("idx").isNotNull())
         .select(*k, "idx", F.col("a.head").alias("head"), F.col("a.rel").alias("rel")))
    return (a.groupBy(*k, (F.col("head") - 1).alias("parent"), "rel")
             .agg(F.sort_array(F.collect_list("idx")).alias("children")))


def _typed_tokens(sents: DataFrame, keys, **more) -> DataFrame:
    """(keys…, idx, word, type, _isl, and the arrays of ``more`` by name): tokens with their entity type and the number of entity chunks begun so
    far, a running sum over each sentence."""
    k = list(keys)
    z = F.arrays_zip(F.col("words").alias("w"), F.col("netags").alias("n"), *[F.col(c).alias(name) for name, c in more.items()])
    t = (sents.select(*k, F.posexplode_outer(z).alias("idx", "x")).where(F.col("idx").isNotNull())
              .select(*k, F.col("idx").cast("int").alias("idx"), F.col("x.w").alias("word"), *[F.col(f"x.{name}") for name in more],
                      F.when(F.col("x.n") == "O", F.lit(None)).otherwise(F.element_at(F.split(F.col("x.n"), "-"), -1)).alias("type")))
    w = Window.partitionBy(*k).orderBy("idx")
    prev = F.lag("type").over(w)
    change = F.when(F.col("type").isNotNull() & (prev.isNull() | (prev != F.col("type"))), 1).otherwise(0)
    return t.withColumn("_isl", F.sum(change).over(w))


def _spelled(tokens) -> "Column":
    return F.array_join(F.transform(F.sort_array(tokens), lambda s: s["word"]), "")


def ner_islands(sents: DataFrame, keys) -> DataFrame:
    """Entity chunks (keys…, type, start, end, name) from BIES tags.

    The original compares upper-case tag classes to lower-case letters, so
    B/I/E/S never split a run: a chunk is a maximal run of one entity type
    (neighbouring same-type entities fuse).  Gaps-and-islands with a running
    sum over each sentence.
    """
    k = list(keys)
    isl = _typed_tokens(sents, k).where(F.col("type").isNotNull())
    return (isl.groupBy(*k, "_isl")
               .agg(F.first("type").alias("type"), F.min("idx").alias("start"), (F.max("idx") + 1).alias("end"),
                    _spelled(F.collect_list(F.struct("idx", "word"))).alias("name"))
               .drop("_isl"))


def coarse_tokens(sents: DataFrame, keys) -> DataFrame:
    """(keys…, pos, word, nature): tokens with every entity chunk fused
    into one token whose POS is the lower-cased type; a sentence without any
    entity yields no tokens (as in the original).

    A chunk covers the places of its own tokens and no others, so one pass over
    the tokens of a sentence finds the chunks and what they leave: nothing is
    joined.
    """
    k = list(keys)
    typed = F.col("type").isNotNull()
    here = Window.partitionBy(*k).orderBy("idx").rangeBetween(Window.currentRow, Window.currentRow)
    known = [F.col(c).isNotNull() for c in k]
    t = (_typed_tokens(sents, k, postag="postags").withColumn("_covered", F.max(typed).over(here))
         .withColumn("_any", F.max(typed).over(Window.partitionBy(*k))).where("_any"))
    plain = ~F.col("_covered")
    for c in known:
        plain = plain & c
    g = t.groupBy(*k, "_isl").agg(
        F.collect_list(F.when(plain, F.struct(F.col("idx").alias("pos"), "word", F.col("postag").alias("nature")))).alias("_plain"),
        F.min(F.when(typed, F.col("idx"))).alias("_start"), F.first("type", ignorenulls=True).alias("_type"),
        _spelled(F.collect_list(F.when(typed, F.struct("idx", "word")))).alias("_name"))
    fused = F.when(F.col("_type").isNotNull(), F.array(F.struct(
        F.col("_start").alias("pos"), F.col("_name").alias("word"), F.lower("_type").alias("nature")))).otherwise(F.array().cast(
            "array<struct<pos:int,word:string,nature:string>>"))
    return g.select(*k, F.explode(F.concat("_plain", fused)).alias("x")).select(*k, "x.pos", "x.word", "x.nature")


def core_words(sents: DataFrame, keys) -> DataFrame:
    """(keys…, idx, word, offe, depth): the root (HED) plus every token
    reachable from it through COO arcs; offe = length of the words before.

    Pointer doubling inside the sentence row: a COO token points to its head,
    any other token to itself, and ⌈log2 n⌉ passes of ``to = to[to]`` reach the
    end of every chain of n COO tokens, none of them when there is only one.  Tokens on a COO cycle never reach a
    root and are not returned.  No join, no shuffle.
    """
    k = list(keys)
    coo = lambda a: (a["rel"] == "COO") & a["head"].between(1, F.size("arcs"))
    start = F.transform("arcs", lambda a, i: F.struct(
        F.when(coo(a), a["head"] - 1).otherwise(i).cast("int").alias("to"), coo(a).cast("int").alias("depth")))

    def double(hops, _):
        return F.transform(hops, lambda h: F.struct(
            F.get(hops, h["to"])["to"].alias("to"), (h["depth"] + F.get(hops, h["to"])["depth"]).alias("depth")))

    steps = sents.select(*k, "words", "arcs", F.size(F.filter("arcs", coo)).alias("n"), start.alias("start"))
    passes = F.sequence(F.lit(1), F.ceil(F.log2(F.greatest(F.col("n"), F.lit(2)))).cast("int"))
    hops = steps.select(*k, "words", "arcs", F.when(F.col("n") < 2, F.col("start")).otherwise(F.aggregate(passes, F.col("start"), double)).alias("hops"))
    # The rooted tokens are picked inside the row, so that the sentence is not copied for each of its tokens.
    rooted = F.filter(F.transform("hops", lambda h, i: F.when(F.get("arcs", h["to"])["rel"] == "HED", F.struct(
        i.alias("idx"), h["depth"].alias("depth"), F.get("words", i).alias("word"),
        F.length(F.array_join(F.slice("words", F.lit(1), i), "")).cast("int").alias("offe")))), lambda x: x.isNotNull())
    return hops.select(*k, F.explode_outer(rooted).alias("x")).where(F.col("x").isNotNull()).select(*k, "x.idx", "x.depth", "x.word", "x.offe")


# --- per-sentence triples (X2, X4, X5) -------------------------------------

#: Dependents whose phrases come before their head word; those of COO and VOB come behind it, in this order.
_AHEAD = ("SBV", "ATT")
_TRIPLE = {"sub": pa.string(), "verb": pa.string(), "obj": pa.string(), "type": pa.string()}
_READ = pa.struct({"ts": pa.list_(pa.struct(_TRIPLE)), "core": pa.list_(pa.struct({"word": pa.string(), "offe": pa.int32()}))})
_TOLD = pa.list_(pa.struct(_TRIPLE | {"core": pa.bool_()}))


def _spans(words, tags, heads, rels):
    """The words and separators of all phrases in reading order, and where every token's phrase begins and ends in them.

    The phrases are a forest: a token's phrase is its word with the phrases of
    its SBV and ATT before it and those of its COO and VOB behind it.  The
    separator of a coordinated token comes before the token's whole phrase and
    is a part of its head's phrase only.  A token on or below a cycle stands
    alone.  One walk from the tops spells everything, so the cost does not
    depend on the depth of the forest.
    """
    n = len(heads)
    ahead, behind, apart, tops = {}, {}, set(), []
    seen, unsure_rels, unsure_heads, unsure = set(), set(), set(), False
    for i, (head, rel) in enumerate(zip(heads, rels)):
        part = rel == "ATT" or rel == "COO"
        if not part and (rel == "SBV" or rel == "VOB"):  # the first of its kind, of which nothing unknown casts doubt
            part = (head is not None and 0 < head <= len(tags) and tags[head - 1] == "v" and (head, rel) not in seen
                    and not unsure and rel not in unsure_rels and head not in unsure_heads)
        if head is None:
            unsure = unsure or rel is None
            unsure_rels.add(rel)
        elif rel is None:
            unsure_heads.add(head)
        else:
            seen.add((head, rel))
        if part and head is not None and 1 <= head <= n:
            (ahead if rel in _AHEAD else behind).setdefault(head - 1, []).append(i)
            if rel == "COO" and head != i:
                apart.add(i)
        else:
            tops.append(i)
    # Of what is put on a stack the last comes first: SBV before ATT, COO before VOB.
    for below, then in ((ahead, "ATT"), (behind, "VOB")):
        for at, found in below.items():
            if len(found) > 1:
                below[at] = sorted(reversed(found), key=lambda i: rels[i] != then)
    stream, begin, end, last = [], [-1] * n, [-1] * n, []
    m = len(words)
    for top in tops:
        todo = [top]
        while todo:
            i = todo.pop()
            if i < 0:  # what comes before the word ~i is told
                i = ~i
                after = behind.get(i)
            else:
                if i in apart:
                    stream.append("、")
                begin[i] = len(stream)
                before = ahead.get(i)
                if before:
                    todo.append(~i)
                    todo.extend(before)
                    continue
                after = behind.get(i)
            if i < m and words[i] is not None:
                stream.append(words[i])
            if after:
                last.append((after[0], i))
                todo.extend(after)
            else:
                end[i] = len(stream)
    # A phrase with tokens behind its word ends where the last of them does.
    for j, i in reversed(last):
        end[i] = end[j]
    return stream, begin, end


def _verb_triples(words, tags, heads, rels):
    """[sub, verb, obj, type] of every token with POS ``v``, by the first rule that fits its children."""
    stream, begin, end = _spans(words, tags, heads, rels)
    n, first = len(heads), {}
    for i, (head, rel) in enumerate(zip(heads, rels)):
        if rel in ("SBV", "VOB", "CMP", "POB", "FOB"):
            first.setdefault((head, rel), i)

    def word(i):
        return words[i] if i < len(words) else None

    def phrase(i):
        if i is None or not 0 <= i < n:
            return ""
        return "".join(stream[begin[i]:end[i]]) if begin[i] >= 0 else word(i) or ""

    def joined(x, y):
        return None if x is None or y is None else x + y

    out = []
    for i in range(n):
        if i >= len(tags) or tags[i] != "v":
            continue
        sbv, vob, cmp_, fob = (first.get((i + 1, r)) for r in ("SBV", "VOB", "CMP", "FOB"))
        verb, rel = word(i), rels[i]
        if sbv is not None and vob is not None:
            out.append([phrase(sbv), verb, phrase(vob), "主谓宾"])
        elif rel == "ATT":
            # An attributive verb: its head is the subject, unless the head's phrase still tells the verb and object.
            if vob is not None and verb is not None:
                noun, obj = phrase(None if heads[i] is None else heads[i] - 1), phrase(vob)
                told = verb + obj
                noun = noun.removeprefix(told)
                if told not in noun:
                    out.append([noun, verb, obj, "补主"])
        elif sbv is not None and cmp_ is not None:
            place = first.get((cmp_ + 1, "POB"))
            if place is not None:
                out.append([phrase(sbv), joined(verb, word(cmp_)), phrase(place), "补宾"])
        elif sbv is not None:
            out.append([phrase(sbv), verb, "", "主谓"])
        elif vob is not None:
            out.append(["", verb, phrase(vob), "谓宾"])
        elif fob is not None:
            out.append(["", verb, phrase(fob), "宾前"])
    return out


def _core_list(words, heads, rels):
    """X3 in order of discovery: (word, offe) of the roots and, under each, the coordinated tokens.

    The coordinated tokens of one word come together before those of their own
    coordinated tokens.
    """
    n, under = len(heads), {}
    for i, (head, rel) in enumerate(zip(heads, rels)):
        if rel == "COO" and head is not None and 1 <= head <= n:
            under.setdefault(head - 1, []).append(i)
    found = []
    for top in (i for i, rel in enumerate(rels) if rel == "HED"):
        found.append(top)
        todo = [top]
        while todo:
            below = under.get(todo.pop(), ())
            found.extend(below)
            todo.extend(reversed(below))
    before = [0, *accumulate(len(w or "") for w in words)]
    return [(words[i] if i < len(words) else None, before[min(i, len(words))]) for i in found]


def _joined(found, core, right_len):
    """(triples, core) after every pair of consecutive core words has been applied in turn."""
    where, filled = None, False

    def pair(k):
        if 0 <= k < len(found) - 1 and found[k][1] is not None and found[k + 1][1] is not None:
            heappush(where.setdefault((found[k][1], found[k + 1][1]), []), k)

    out = []
    for (left, offe), (right, following) in zip(core, core[1:]):
        at, measured = None, left if right_len else right
        if measured is not None and offe + len(measured) == following:
            if where is None:
                where = {}
                for k in range(len(found) - 1):
                    pair(k)
            places = where.get((left, right), [])
            while places and (found[places[0]][1], found[places[0] + 1][1]) != (left, right):
                heappop(places)  # a join has changed the verbs there
            if places:
                at = places[0]
                found[at] = [found[at][0], left + right, found[at + 1][2], "主谓宾"]
                pair(at - 1)
                pair(at)
        elif measured is not None and not filled:
            # Blanks take the last subject and object told; afterwards none is left, or nothing to fill them with.
            filled = True
            sub, obj = (next((t[f] for t in reversed(found) if t[f]), "") for f in (0, 2))
            for t in found:
                t[0], t[2] = t[0] or sub, t[2] or obj
        out.append((left if at is None else left + right, offe))
    return found, out + core[-1:]


#: Tokens of which Python objects are made at a time.
_TOKENS_AT_ONCE = 1 << 17


def _flat(values: pa.Array) -> list:
    """Elements as Python objects, faster than one by one."""
    return values.to_pylist() if values.null_count and not pa.types.is_string(values.type) else values.to_numpy(zero_copy_only=False).tolist()


def _read_rows(words: pa.Array, tags: pa.Array, arcs: pa.Array, right_len: bool, verbs_only: bool = False):
    """Triples and joined core words of every sentence, null where one of the arrays is; ``verbs_only``: nothing of sentences without a verb."""
    n = len(words)
    known = pc.and_(pc.and_(words.is_valid(), tags.is_valid()), arcs.is_valid()).to_numpy(zero_copy_only=False)
    ends = [x.offsets.to_numpy() for x in (words, tags, arcs)]
    heads, rels = pc.struct_field(arcs.values, "head"), pc.struct_field(arcs.values, "rel")
    verbs = np.concatenate([[0], np.cumsum(pc.equal(tags.values, "v").fill_null(False).to_numpy(zero_copy_only=False))])
    wanted = known & (verbs[ends[1][1:]] > verbs[ends[1][:-1]]) if verbs_only else known
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends[2], ends[2][at] + _TOKENS_AT_ONCE, "right")) - 1)
        (w, t, h), r = ([_flat(x[e[at]:e[to]]) for x, e in zip((words.values, tags.values, heads), ends)], _flat(rels[ends[2][at]:ends[2][to]]))
        (wb, tb, ab) = ((e[at:to + 1] - e[at]).tolist() for e in ends)
        for i in range(to - at):
            if not wanted[at + i]:
                yield ([], []) if known[at + i] else None
                continue
            ws, hs, rs = w[wb[i]:wb[i + 1]], h[ab[i]:ab[i + 1]], r[ab[i]:ab[i + 1]]
            yield _joined(_verb_triples(ws, t[tb[i]:tb[i + 1]], hs, rs), _core_list(ws, hs, rs), right_len)
        at = to


def _read(sents: DataFrame, keys, right_len: bool) -> DataFrame:
    """(keys…, r): triples ``r.ts`` and joined core words ``r.core`` of every sentence with words, tags and arcs.

    Read by a Python function of the three arrays, linear in the sentence's
    tokens and its triples' text; the other columns do not go there.
    """
    @F.arrow_udf("struct<ts:array<struct<sub:string,verb:string,obj:string,type:string>>,core:array<struct<word:string,offe:int>>>")
    def read(words: pa.Array, tags: pa.Array, arcs: pa.Array) -> pa.Array:
        rows = [x and {"ts": [dict(zip(_TRIPLE, t)) for t in x[0]], "core": [{"word": w, "offe": o} for w, o in x[1]]}
                for x in _read_rows(words, tags, arcs, right_len)]
        return pa.array(rows, _READ)

    # A filter on the arrays would be pushed down to where they are made and make them a second time, for every token if it looks at each.
    return sents.select(*keys, read("words", "postags", "arcs").alias("r")).where(F.col("r").isNotNull())


def triples(sents: DataFrame, keys, right_len: bool = False) -> DataFrame:
    """(keys…, k, sub, verb, obj, type, core): the triples of every sentence.

    ``core`` tells whether the verb is one of the sentence's joined core words
    (E2 keeps those).  Read inside the sentence row: no join, no shuffle.
    Two core words touch when the length of the right one
    leads from one offset to the next, as in the original; ``right_len`` takes
    the length of the left one.  Sentences without words, tags or arcs give no
    rows.
    """
    k = list(keys)

    @F.arrow_udf("array<struct<sub:string,verb:string,obj:string,type:string,core:boolean>>")
    def told(words: pa.Array, tags: pa.Array, arcs: pa.Array) -> pa.Array:
        rows = []
        for ts, core in (x or ([], []) for x in _read_rows(words, tags, arcs, right_len, verbs_only=True)):
            listed = {w for w, _ in core}
            unsure = None if None in listed else False
            rows.append([{"sub": s, "verb": v, "obj": o, "type": kind, "core": None if v is None else v in listed or unsure} for s, v, o, kind in ts])
        return pa.array(rows, _TOLD)

    rows = sents.select(*k, F.posexplode_outer(told("words", "postags", "arcs")).alias("k", "t"))
    return rows.where(F.col("k").isNotNull()).select(*k, "k", "t.sub", "t.verb", "t.obj", "t.type", "t.core")


def joined_core_words(sents: DataFrame, keys, right_len: bool = False) -> DataFrame:
    """X3 after X5: (keys…, k, word, offe), touching core words whose triples were joined as one."""
    k = list(keys)
    rows = _read(sents, k, right_len).select(*k, F.posexplode_outer("r.core").alias("k", "c"))
    return rows.where(F.col("k").isNotNull()).select(*k, "k", "c.word", "c.offe")


def read_sentences(sents: DataFrame, keys, right_len: bool = False) -> DataFrame:
    """(keys…, words, triples, core): triples and joined core words as arrays in the sentence row."""
    return _read(sents, [*keys, "words"], right_len).select(*keys, "words", F.col("r.ts").alias("triples"), F.col("r.core").alias("core"))


# --- F4: merge tokens covered by a special chunk -----------------------------

def merge_chunk_tokens(seg: "Column", chunks: "Column") -> "Column":
    """F4 as a fold over one sentence's tokens (array<struct<word, nature, offset>>).

    ``chunks`` is array<struct<chunk, start, end>> (see ``text.chunk_offsets``).
    A token starting where a chunk starts (when no chunk is open) is replaced
    by one ``n`` token holding the chunk text; following tokens are skipped
    until a token starts exactly at the chunk's end — if none does, the rest
    of the sentence is dropped (as in the original).  For equal starts the
    last-listed chunk wins.

    The fold is a Python loop, linear in tokens and chunks: a fold of array
    functions copies its output, and looks through all chunks, for every token.
    Sentences without chunks pass through untouched and are not sent there.
    """
    @F.udf("array<struct<word:string,nature:string,offset:int>>")
    def fold(seg, chunks):
        if seg is None:
            return None
        last = {c.start: c for c in chunks or () if c is not None and c.start is not None}
        out, end, open_ = [], None, False
        for t in seg:
            if end is not None and t.offset == end:
                end, open_ = None, False
            hit = last.get(t.offset) if end is None else None
            if hit is not None:
                out.append((hit.chunk, "n", t.offset))
                end, open_ = hit.end, True
            elif not open_:
                out.append((t.word, t.nature, t.offset))
        return out

    some = F.size(chunks) > 0
    plain = F.transform(seg, lambda t: F.struct(t["word"].alias("word"), t["nature"].alias("nature"),
                                                t["offset"].cast("int").alias("offset")))
    folded = fold(F.when(some, seg), F.when(some, chunks))
    return F.when(some, folded).otherwise(plain)


def role_triples(roles: DataFrame, sents: DataFrame, keys) -> DataFrame:
    """Per predicate, the A0 / A1 / TMP / LOC argument spans as text.

    ``roles`` is (keys…, pred, role, start, end) with inclusive token spans.
    The roles of a sentence meet its words as one row, so tokens are never
    exchanged one by one; sentences that share a key are read together, each
    telling its own verbs.
    """
    k = list(keys)
    kind = roles.schema["pred"].dataType
    out = T.ArrayType(T.StructType([T.StructField("pred", kind)] + [T.StructField(c, T.StringType()) for c in ("sub", "verb", "obj", "tmp", "loc")]))
    made = to_arrow_type(out)
    arrays = [F.size(c) for c in ("words", "postags", "arcs")]
    tokens = F.when(F.col("words").isNotNull() & F.col("postags").isNotNull() & F.col("arcs").isNotNull(), F.greatest(*arrays)).otherwise(0)
    told = roles.select(*k, F.struct("pred", "role", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")).alias("r"))
    told = told.groupBy(*k).agg(F.collect_list("r").alias("_roles"))
    # Words travel as one text: an array takes some times as much.
    read = sents.select(*k, F.struct(F.to_json("words").alias("words"), tokens.alias("n")).alias("s")).repartition(*k).groupBy(*k).agg(F.collect_list("s").alias("_sents"))

    @F.arrow_udf(out)
    def spelled(roles: pa.Array, sents: pa.Array) -> pa.Array:
        return pa.array([_spelled_roles(r.as_py(), s.as_py()) for r, s in zip(roles, sents)], made)

    rows = told.join(read, k).select(*k, spelled("_roles", "_sents").alias("x"))
    return rows.select(*k, F.explode_outer("x").alias("x")).where(F.col("x").isNotNull()).select(*k, "x.*")


def _spelled_roles(roles, sents):
    """Rows (pred, sub, verb, obj, tmp, loc) of the sentences of one key."""
    words = [s["words"] and json.loads(s["words"]) for s in sents]
    last = max((len(w) - 1 for w in words if w is not None), default=None)
    tokens = [(w or [])[:s["n"]] + [None] * (s["n"] - len(w or ())) for w, s in zip(words, sents)]
    spans: dict = {}
    for r in roles:
        ends = [x for x in (r["end"], last) if x is not None]
        if ends:
            at = slice(max(r["start"] or 0, 0), max(min(ends) + 1, 0))
            found = [(i, w is not None, w) for words in tokens for i, w in enumerate(words[at], at.start)]
            if found:
                spans.setdefault((r["pred"], r["role"]), []).extend(found)
    texts = {p: "".join(w for _, there, w in sorted(found, key=lambda x: (x[0], x[2] or "")) if there) for p, found in spans.items()}
    return [{"pred": p, "sub": texts.get((p, "A0"), ""), "verb": words[p], "obj": texts.get((p, "A1"), ""), "tmp": texts.get((p, "TMP")), "loc": texts.get((p, "LOC"))}
            for p in dict.fromkeys(r["pred"] for r in roles) if p is not None for words in tokens if 0 <= p < len(words)]
