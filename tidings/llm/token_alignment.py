"""Alignment of two tokenizers by products of incidence matrices.

Both tokenizers cut the same bytes.  With the token-byte incidence matrices A
and B of a batch, row products A·Bᵀ give the overlap links: token pairs that
share a byte, with the number of shared bytes.  Where consecutive overlap
links change both tokens, both tokenizers end a token, and a group ends.  The
group incidence matrices (distinct ids by groups, with counts) give, by the
product of the A ids' rows with the transposed B matrix, the shared-group
links of every document: id pair and number of linked occurrences.  Matrices
are compressed sparse rows built with numpy; products run in blocks of rows,
so that a block's partial products are bounded.

Corpus counts: documents are aligned block by block, and a document names its
id pairs by numbers into its block's list of distinct pairs.  The lists are
summed over the corpus by pair (a pair has one row per block, however common
it is), and each block's documents meet the counts of its own list again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import short_batches, staged
from .token_cache import content, model_path, processor

LEFT = "byte_bpe_50k.json"
RIGHT = "piece_bpe_32k.model"
#: UTF-8 bytes of a block's documents, of the documents aligned at once (one longer document is by itself), and partial products at once.
BLOCK_BYTES = 8 << 20
RUN_BYTES = 1 << 20
PRODUCTS = 1 << 20
#: Words (with other than Latin signs) whose left ids a task keeps; beyond that it begins anew.
KNOWN_WORDS = 300_000

#: A space between printable ASCII characters begins a word of the left tokenizer, whatever stands around it.
_SPACE = re.compile(r"(?<=[!-~]) (?=[!-~])")
#: Beyond the Latin blocks that all Unicode versions of the last twenty years class alike.
_OTHER = re.compile("[^\x00-\u024f]")


def _plain(text: str) -> bool:
    return text.isascii() or _OTHER.search(text) is None


class Csr(NamedTuple):
    """Compressed sparse rows; ``columns`` is the number of columns."""
    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int


def incidence(rows: np.ndarray, columns: np.ndarray, n_rows: int, n_columns: int) -> Csr:
    """Counts of equal (row, column) entries, rows and columns ascending."""
    key, data = np.unique(rows * n_columns + columns, return_counts=True)
    row = key // n_columns
    return Csr(np.searchsorted(row, np.arange(n_rows + 1)), key - row * n_columns, data, n_columns)


def transposed(m: Csr) -> Csr:
    n_rows = len(m.indptr) - 1
    rows = np.repeat(np.arange(n_rows), np.diff(m.indptr))
    order = np.argsort(m.indices, kind="stable")
    return Csr(np.searchsorted(m.indices[order], np.arange(m.columns + 1)), rows[order], m.data[order], n_rows)


def product(a: Csr, b: Csr, at_once: int = PRODUCTS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, columns and values of a·b, ascending: every row of ``a`` merges the rows of ``b`` it points at.

    Blocks of rows with at most ``at_once`` partial products; a row with more is a block by itself.
    """
    fan = np.diff(b.indptr)[a.indices]
    # Rows of one entry each: the partial products stand where the entries of ``a`` stand.
    single = bool((fan == 1).all())
    upto = np.zeros(0, np.int64) if single else np.concatenate([[0], np.cumsum(fan)])
    by_row = a.indptr if single else upto[a.indptr]
    row, last = 0, len(a.indptr) - 1
    while row < last:
        end = max(row + 1, int(np.searchsorted(by_row, by_row[row] + at_once, "right")) - 1)
        first, stop = a.indptr[row], a.indptr[end]
        of_row = np.repeat(np.arange(row, end), np.diff(a.indptr[row:end + 1]))
        if single:
            entry, source = slice(first, stop), b.indptr[a.indices[first:stop]]
        else:
            part = fan[first:stop]
            entry = np.repeat(np.arange(first, stop), part)
            source = np.arange(by_row[row], by_row[end]) + np.repeat(b.indptr[a.indices[first:stop]] - upto[first:stop], part)
            of_row = of_row[entry - first]
        column = b.indices[source]
        key = of_row * b.columns + column
        value = a.data[entry] * b.data[source]
        if len(key):
            step = np.diff(key)
            if (step < 0).any():
                order = np.argsort(key, kind="stable")
                of_row, column, value = of_row[order], column[order], value[order]
                step = np.diff(key[order])
            cut = np.concatenate([[0], np.flatnonzero(step) + 1])
            yield of_row[cut], column[cut], np.add.reduceat(value, cut)
        row = end


def whole_product(a: Csr, b: Csr, at_once: int = PRODUCTS) -> tuple[np.ndarray, ...]:
    blocks = list(product(a, b, at_once))
    return tuple(np.concatenate(x) for x in zip(*blocks)) if blocks else (np.zeros(0, np.int64),) * 3


class Tables:
    """Bytes and decimal names of both vocabularies, and the encoders."""

    def __init__(self, left: str, right: str):
        from tokenizers import Tokenizer
        self.a, self.b = Tokenizer.from_file(model_path(left)), processor(right)
        self.a.encode_special_tokens = True
        # The printable stand-ins of byte-level vocabularies: kept bytes stand for themselves, the others are numbered from 256 on.
        kept = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
        stand_in = {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(kept)))}
        special = set(self.a.get_added_tokens_decoder())
        self.a_bytes = [b"".join(bytes([stand_in[c]]) for c in t) if i not in special else t.encode()
                        for i, t in ((i, self.a.id_to_token(i)) for i in range(self.a.get_vocab_size()))]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(len(self.b)))]
        self.a_size, self.b_size = (np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self.a_spelled, self.b_spelled = (np.array(table, object) for table in (self.a_bytes, self.b_bytes))
        self.ranked = self._ranked(left)
        # Every id's name followed by each sign that can come after it.
        self.na, self.nb = len(self.a_bytes), len(self.b_bytes)
        self.names = np.array([f"{i}{sign}".encode() for n, signs in ((self.na, ",|"), (self.nb, ",;")) for sign in signs for i in range(n)], object)

    def _ranked(self, left: str):
        """The left vocabulary as ranks, for words of Latin signs; None if its ids do not follow its merges.

        The libraries know different Unicode versions, in which the Latin signs are the same.
        """
        import json

        import public_tokenizers
        import tiktoken
        with open(model_path(left), encoding="utf-8") as f:
            made = json.load(f)
        vocab, merges = made["model"]["vocab"], made["model"]["merges"]
        ids = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        added = {t["id"] for t in made["added_tokens"]}
        if ids != list(range(256, 256 + len(ids))) or made["pre_tokenizer"]["type"] != "ByteLevel":
            return None
        ranks = {t: i for i, t in enumerate(self.a_bytes) if i not in added}
        return tiktoken.Encoding("left", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def left_ids(self, text: str, known: dict[str, bytes]) -> np.ndarray:
        if self.ranked is not None and _plain(text):
            return self.ranked.encode_to_numpy(" " + text, disallowed_special=())
        parts = []
        for plain, words in groupby(_SPACE.split(text), _plain):
            if plain and self.ranked is not None:
                parts.append(self.ranked.encode_to_numpy(" " + " ".join(words), disallowed_special=()).tobytes())
            else:
                parts += [known[w] for w in words]
        return np.frombuffer(b"".join(parts), "<u4")

    def encode(self, texts: list[str], known: dict[str, bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of space+text and of text; ``known`` keeps the left ids of words already met."""
        fresh = list({w for t in texts if self.ranked is None or not _plain(t) for w in _SPACE.split(t)
                      if w not in known and (self.ranked is None or not _plain(w))})
        for at in range(0, len(fresh), 1024):
            part = fresh[at:at + 1024]
            for w, e in zip(part, self.a.encode_batch_fast([" " + w for w in part], add_special_tokens=False)):
                known[w] = np.array(e.ids, "<u4").tobytes()
        return [self.left_ids(t, known) for t in texts], [np.array(ids, np.int64) for ids in self.b.encode(texts, num_threads=1)]

    def left_spells(self, ids: np.ndarray, text: str, spelled: bytes) -> bool:
        """Whether left ids spell space+text.  Ranks spell pieces of the text one after the other: equal in length, they spell it all."""
        if self.ranked is not None and _plain(text):
            return int(self.a_size[ids].sum()) == len(spelled)
        return self.spells(ids, self.a_spelled, spelled)

    def spells(self, ids: np.ndarray, table: np.ndarray, text: bytes) -> bool:
        return b"".join(table[ids].tolist()) == text


@cache
def tables(left: str, right: str) -> Tables:
    return Tables(left, right)


class Run(NamedTuple):
    """Alignment of some documents; arrays by document, then pairs in document order."""
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_overlaps: np.ndarray
    groups: list[bytes]
    pair_ends: np.ndarray
    pairs: np.ndarray
    links: np.ndarray


def align_tokens(table: Tables, a_docs: list[np.ndarray], b_docs: list[np.ndarray], products: int = PRODUCTS) -> Run:
    """Align documents whose two token lists spell the same bytes (both may be empty)."""
    docs = len(a_docs)
    n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (a_docs, b_docs))
    a, b = (np.concatenate([np.zeros(0, np.int64), *side]).astype(np.int64) for side in (a_docs, b_docs))
    a_end, b_end = np.cumsum(table.a_size[a]), np.cumsum(table.b_size[b])
    size = int(a_end[-1]) if len(a) else 0
    ones = np.ones(size, np.int64)
    # Token-byte incidence: token i covers the bytes up to its end; transposed, a byte has one token.
    left = Csr(np.concatenate([[0], a_end]), np.arange(size), ones, size)
    right = Csr(np.arange(size + 1), np.repeat(np.arange(len(b)), table.b_size[b]), ones, len(b))
    i, j, _ = whole_product(left, right, products)
    new = np.concatenate([[False], (np.diff(i) > 0) & (np.diff(j) > 0)]) if len(i) else np.zeros(0, bool)
    group = np.cumsum(new)
    a_group, b_group = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    a_group[i], b_group[j] = group, group
    total = int(group[-1]) + 1 if len(group) else 0
    a_doc = np.repeat(np.arange(docs), n_a)
    group_doc = np.zeros(total, np.int64)
    group_doc[a_group] = a_doc
    # Names in the order of groups, left ids before right ids.
    a_last = np.concatenate([np.diff(a_group) > 0, [True]]) if len(a) else np.zeros(0, bool)
    b_last = np.concatenate([np.diff(b_group) > 0, [True]]) if len(b) else np.zeros(0, bool)
    order = np.empty(len(a) + len(b), np.int64)
    a_upto, b_upto = (np.cumsum(np.bincount(side, minlength=total)) for side in (a_group, b_group))
    order[np.arange(len(a)) + np.concatenate([[0], b_upto])[a_group]] = a + a_last * table.na
    order[np.arange(len(b)) + a_upto[b_group]] = b + 2 * table.na + b_last * table.nb
    ends = np.cumsum(n_a + n_b)
    names = [b"".join(table.names[order[u:v]].tolist())[:-1] for u, v in zip((ends - n_a - n_b).tolist(), ends.tolist())]
    # Group incidence: rows are the ids of each document, columns its groups.
    # (A token list stands in the order of its groups, so one sort by id gives rows and columns ascending.)
    key = a_doc * table.na + a
    by_key = np.argsort(key, kind="stable")
    key, column = key[by_key], a_group[by_key]
    new_row = np.concatenate([[True], np.diff(key) > 0])[:len(key)]
    cell = np.flatnonzero(new_row | np.concatenate([[True], np.diff(column) > 0])[:len(key)])
    key, row = key[new_row], (np.cumsum(new_row) - 1)[cell]
    by_id = Csr(np.searchsorted(row, np.arange(len(key) + 1)), column[cell], np.diff(np.append(cell, len(a))), max(total, 1))
    by_group = incidence(b_group, b, max(total, 1), table.nb)
    row, column, links = whole_product(by_id, by_group, products)
    key_doc, key_id = np.divmod(key, table.na)
    pairs = (key_id * table.nb)[row] + column if len(row) else np.zeros(0, np.int64)
    pair_doc = key_doc[row] if len(row) else np.zeros(0, np.int64)
    return Run(n_a, n_b, np.bincount(group_doc, minlength=docs), np.bincount(a_doc[i], minlength=docs), names,
               np.searchsorted(pair_doc, np.arange(docs), "right"), pairs, links)


_STATS = ["n_a", "n_b", "n_groups", "n_overlaps"]
_PAIR = pa.struct([("pair", pa.int64()), ("docs", pa.int64())])


def _align(left: str, right: str, block_bytes: int, run_bytes: int, id_type: pa.DataType):
    names = ["block", "doc_id", *_STATS, "groups", "refs", "links", "pairs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        table = tables(left, right)
        block, size, known, done = TaskContext.get().partitionId() << 32, 0, {}, []

        def one(texts: list[str]) -> Run:
            nonlocal known
            if len(known) > KNOWN_WORDS:
                known = {}
            a_docs, b_docs = table.encode(texts, known)
            for k, text in enumerate(texts):
                spelled = b" " + text.encode()
                if not text or not table.spells(b_docs[k], table.b_spelled, spelled) or not table.left_spells(a_docs[k], text, spelled):
                    a_docs[k], b_docs[k] = np.zeros(0, np.int64), np.zeros(0, np.int64)
            return align_tokens(table, a_docs, b_docs)

        def close() -> Iterator[pa.RecordBatch]:
            pairs, refs, docs = np.unique(np.concatenate([r.pairs for _, r in done]), return_inverse=True, return_counts=True)
            at = 0
            for ids, r in done:
                n = len(ids)
                ends = np.concatenate([[0], r.pair_ends])
                own, links = refs[at:at + len(r.pairs)].astype("<u4"), r.links.astype("<i8")
                at += len(r.pairs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * n, pa.int64()), ids, *[pa.array(getattr(r, s), pa.int64()) for s in _STATS], pa.array(r.groups, pa.binary()).cast(pa.string()),
                     pa.array([own[u:v].tobytes() for u, v in zip(ends, ends[1:])], pa.binary()),
                     pa.array([links[u:v].tobytes() for u, v in zip(ends, ends[1:])], pa.binary()), pa.nulls(n, pa.list_(_PAIR))], names)
            # A list per some pairs: no row grows with the block's vocabulary.
            for u in range(0, len(pairs), 1 << 16):
                v = min(len(pairs), u + (1 << 16))
                both = pa.StructArray.from_arrays([pa.array(pairs[u:v], pa.int64()), pa.array(docs[u:v], pa.int64())], fields=list(_PAIR))
                empty = [pa.nulls(1, pa.int64()) for _ in _STATS[1:]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.nulls(1, id_type), pa.array([u], pa.int64()), *empty, pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                     pa.ListArray.from_arrays(pa.array([0, v - u], pa.int32()), both)], names)

        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            at = 0
            while at < batch.num_rows:
                end, part, taken = at, [], 0
                while end < batch.num_rows and (end == at or taken < run_bytes):
                    part.append(texts[end].as_py())
                    taken += len(part[-1].encode())
                    end += 1
                done.append((ids.slice(at, end - at), one(part)))
                size += taken
                if size >= block_bytes:
                    yield from close()
                    block, size, done = block + 1, 0, []
                at = end
        if done:
            yield from close()
    return run


def align(docs: DataFrame, left: str = LEFT, right: str = RIGHT, block_bytes: int = BLOCK_BYTES, run_bytes: int = RUN_BYTES) -> DataFrame:
    """The alignment of every row of ``docs``, block by block, as a written table.

    Document rows: doc_id, n_a, n_b, n_groups, n_overlaps, groups (ids as
    ``a1,a2|b1;a3|b2,b3``), and the shared-group links: refs (unsigned 32-bit
    numbers into the block's list of id pairs) with links (signed 64-bit
    numbers of linked occurrences).  Rows of the block's list: ``pairs`` (A id
    * size of B + B id, with the number of the block's documents that hold it),
    beginning at number ``n_a``; ``pairs`` is null in document rows.

    Texts that are null or empty, or that a tokenizer does not spell back, have
    no tokens.  Null or repeated doc_ids keep their rows; an empty table gives
    no rows; further columns are not read.
    """
    short_batches(docs.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("doc_id", id_type), *T._parse_datatype_string(
        ", ".join(f"{s} long" for s in _STATS) + ", groups string, refs binary, links binary, pairs array<struct<pair: long, docs: long>>").fields])
    rows = docs.select("doc_id", content(F.col("text")).alias("text"))
    return staged(rows.mapInArrow(_align(left, right, block_bytes, run_bytes, to_arrow_type(id_type)), schema), "alignment")


def block_pairs(aligned: DataFrame) -> DataFrame:
    """``in_block, local, pair, docs``: the lists of all blocks."""
    return (aligned.where("pairs IS NOT NULL").select(F.col("block").alias("in_block"), "n_a", F.posexplode("pairs").alias("at", "p"))
            .select("in_block", (F.col("n_a") + F.col("at")).alias("local"), "p.pair", "p.docs"))


def pair_counts(aligned: DataFrame, right: str = RIGHT) -> DataFrame:
    """``pair, a_id, b_id, count, best``: documents of the corpus that hold the pair linked, and whether no pair of its A id has more."""
    width = len(processor(right))
    counts = staged(block_pairs(aligned).groupBy("pair").agg(F.sum("docs").alias("count"))
                    .selectExpr("pair", f"pair div {width} AS a_id", f"pair % {width} AS b_id", "count"), "alignment_counts")
    # At most as many rows as the left vocabulary has ids.
    most = counts.groupBy("a_id").agg(F.max("count").alias("most"))
    return counts.join(most, "a_id").select("pair", "a_id", "b_id", "count", (F.col("count") == F.col("most")).alias("best"))


_SUMS = ["n_links", "n_best", "count_sum"]


def _score(carried: list[str]):
    def run(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        n = pairs.num_rows
        local = pairs.column("local").to_numpy()
        count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
        count[local], best[local] = pairs.column("count").to_numpy(), pairs.column("best").to_numpy()
        sums = []
        for refs, links in zip(docs.column("refs"), docs.column("links")):
            refs, links = np.frombuffer(refs.as_py(), "<u4"), np.frombuffer(links.as_py(), "<i8")
            sums.append((int(links.sum()), int(links @ best[refs]), int(links @ count[refs])))
        found = np.array(sums, np.int64).reshape(-1, 3)
        return pa.table([*(docs.column(c) for c in carried), *(pa.array(found[:, k], pa.int64()) for k in range(3))], names=[*carried, *_SUMS])
    return run


def score(aligned: DataFrame, counts: DataFrame, columns: list[str]) -> DataFrame:
    """The given document columns of ``aligned`` with n_links, n_best and count_sum."""
    coded = block_pairs(aligned).join(counts.select("pair", "count", "best"), "pair").select("in_block", "local", "count", F.col("best").cast("long").alias("best"))
    rows = aligned.where("pairs IS NULL").select("block", "refs", "links", *columns)
    schema = T.StructType([rows.schema[c] for c in columns] + [T.StructField(c, T.LongType()) for c in _SUMS])
    return rows.groupBy("block").cogroup(coded.groupBy("in_block")).applyInArrow(_score(columns), schema)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    aligned = align(docs)
    hashed = aligned.withColumn("groups_sha256", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(""))
    columns = ["doc_id", *_STATS, "groups_sha256"]
    return score(hashed, pair_counts(aligned), columns).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")
