"""Byte-level BPE encoding by replaying the merges over the distinct words of the corpus, and decoding.

A word is one match of the splitting pattern.  Documents are split block by
block; a block writes every document as numbers into its own list of distinct
words.  The entries of all lists (a word has one per block, however common it
is) are dealt out by a checksum of the word, packed, so that the equal words
of all blocks meet and each distinct word of the corpus is replayed once.  A
task puts its words side by side in one symbol sequence and keeps an inverted
index from token pair to the positions that hold it.  Pairs are taken in rank
order; a merge touches the two neighbours of its position and nothing else.
The ids go back to the blocks, whose documents lie in a table bucketed by
block and do not move again.

Pairs that spell the same token have the same rank and share an index entry.
Inside a word the order of merges is the library's: lowest rank first, then
leftmost; a word that is itself a token is that token.
"""

from __future__ import annotations

import base64
import heapq
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import short_batches
from .token_cache import content, model_path

RANKS = "byte_bpe_50k.tiktoken"
#: UTF-8 bytes of the documents of a block (one longer document is a block of its own), and bytes of the entries replayed at once.
BLOCK_BYTES = 16 << 20
REPLAY_BYTES = 4 << 20
_SLICE = 1 << 20


@cache
def vocabulary(ranks: str) -> tuple[list[bytes], dict[bytes, int]]:
    """Token bytes by id, and ids by token bytes, of a rank file."""
    rank = {}
    with open(model_path(ranks), "rb") as f:
        for line in f:
            token, number = line.split()
            rank[base64.b64decode(token)] = int(number)
    tokens = [b""] * (max(rank.values()) + 1)
    for token, number in rank.items():
        tokens[number] = token
    return tokens, rank


def _ranges(signs: list[str]) -> list[tuple[str, str]]:
    """First and last of each run of consecutive code points."""
    codes = np.array([ord(c) for c in signs])
    runs = np.split(codes, np.flatnonzero(np.diff(codes) > 1) + 1)
    return [(chr(r[0]), chr(r[-1])) for r in runs]


@cache
def splitter():
    """The function that cuts a text into words, the matches of the pattern; they cover every text.

    The library knows the letters, numbers and blanks of its own Unicode
    version.  Signs of which the regular expressions here think otherwise
    (newer or older ones) are stood for by a sign of the library's class while
    a text is cut.
    """
    import public_tokenizers
    import regex
    import tiktoken
    signs = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    stand_in = {}
    for kind, example in ((r"\p{L}", "\u4e2d"), (r"\p{N}", "\u00b2"), (r"\s", "\u2003")):
        library = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        theirs = set(bytes(library.encode_ordinary(signs)).decode())
        for sign in theirs ^ set(regex.findall(kind, signs)):
            stand_in.setdefault(sign, "\u2190")
        for sign in theirs & stand_in.keys():
            stand_in[sign] = example
    find = regex.compile(public_tokenizers.PATTERN).findall
    above = re.compile(f"[{min(stand_in)}-\U0010ffff]") if stand_in else None
    odd = re.compile("[" + "".join(f"{re.escape(a)}-{re.escape(b)}" for a, b in _ranges(sorted(stand_in))) + "]") if stand_in else None
    table = str.maketrans(stand_in)

    def split(text: str) -> list[str]:
        if odd is None or text.isascii() or above.search(text) is None or odd.search(text) is None:
            return find(text)
        words, at = [], 0
        for shape in find(text.translate(table)):
            words.append(text[at:at + len(shape)])
            at += len(shape)
        return words

    return split


def replay(words: list[bytes], ranks: str = RANKS) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after the other, and how many each word has."""
    tokens, rank = vocabulary(ranks)
    text = b"".join(words)
    size = len(text)
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    if not size:
        return np.zeros(0, np.uint32), np.zeros(len(words), np.int64)
    single = np.array([rank[bytes([b])] for b in range(256)], np.int32)
    raw = np.frombuffer(text, np.uint8)
    token = array("i", single[raw].tobytes())
    # Position of the symbol on either side; -1 at the borders of a word.
    before, after = np.arange(-1, size - 1, dtype=np.int32), np.arange(1, size + 1, dtype=np.int32)
    borders = ends[(ends > 0) & (ends <= size)]
    after[borders - 1] = -1
    before[0] = -1
    before[borders[borders < size]] = -1
    # The index of the single bytes, filled pair by pair.
    first = np.flatnonzero(after >= 0)
    pair = raw[first].astype(np.int32) << 8 | raw[first + 1]
    by_pair = np.argsort(pair, kind="stable")
    cuts = np.flatnonzero(np.diff(pair[by_pair], prepend=-1))
    known: dict[int, int] = {}
    places: dict[int, array] = {}
    for at, end in zip(cuts, [*cuts[1:], len(first)]):
        spots = first[by_pair[at:end]]
        number = rank.get(text[spots[0]:spots[0] + 2], -1)
        if number >= 0:
            places.setdefault(number, array("i")).frombytes(spots.astype(np.int32).tobytes())
    left, right = array("i", before.tobytes()), array("i", after.tobytes())

    def merged(a: int, b: int) -> int:
        number = known.get(a << 32 | b)
        if number is None:
            number = known[a << 32 | b] = rank.get(tokens[a] + tokens[b], -1)
        return number

    queue = list(places)
    heapq.heapify(queue)
    while queue:
        now = heapq.heappop(queue)
        spots = sorted(places.pop(now))
        for k, i in enumerate(spots):
            a, j = token[i], right[i]
            # Stale when the symbol is gone or its pair has changed since.
            if a < 0 or j < 0 or merged(a, token[j]) != now:
                continue
            token[i], token[j] = now, -1
            nxt = right[i] = right[j]
            if nxt >= 0:
                left[nxt] = i
            lower = False
            for p, q in ((left[i], i), (i, nxt)):
                if p >= 0 and q >= 0 and (number := merged(token[p], token[q])) >= 0:
                    if number not in places:
                        places[number] = array("i")
                        heapq.heappush(queue, number)
                    places[number].append(p)
                    lower |= number < now
            if lower and k + 1 < len(spots):
                # A vocabulary may rank a token below its part: that merge goes first, the rest waits.
                places.setdefault(now, array("i")).extend(spots[k + 1:])
                heapq.heappush(queue, now)
                break
    token = np.frombuffer(token, np.int32)
    alive = token >= 0
    upto = np.concatenate([[0], np.cumsum(alive)])[np.concatenate([[0], ends])]
    ids, counts = token[alive].astype(np.uint32), np.diff(upto)
    # A word that is a token as a whole is that token, also where no merges lead to it.
    whole = [k for k in np.flatnonzero(counts > 1).tolist() if words[k] in rank]
    if whole:
        parts = np.split(ids, upto[1:-1])
        for k in whole:
            parts[k] = np.array([rank[words[k]]], np.uint32)
        ids, counts = np.concatenate(parts), np.array([len(p) for p in parts])
    return ids, counts


def packed(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit integers as four byte planes, of which the high ones compress to nearly nothing."""
    return np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


_BLOCK = ["block", "doc_id", "refs", "part", "places", "sizes", "words"]


def _split(block_bytes: int, parts: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        find = splitter()
        block, size, place = TaskContext.get().partitionId() << 32, 0, {}

        def close() -> Iterator[pa.RecordBatch]:
            words = [w.encode() for w in place]
            part = np.array([zlib.crc32(w) % parts for w in words], np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
            for u, v in zip(cuts.tolist(), [*cuts[1:].tolist(), len(words)]):
                own = order[u:v]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.nulls(1, id_type), pa.nulls(1, pa.binary()), pa.array([int(part[own[0]])], pa.int32()), pa.array([packed(own)], pa.binary()),
                     pa.array([packed(np.array([len(words[i]) for i in own]))], pa.binary()), pa.array([b"".join([words[i] for i in own])], pa.binary())], _BLOCK)

        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            at = 0
            while at < batch.num_rows:
                end, rows = at, []
                while end < batch.num_rows and (end == at or size < block_bytes) and end - at < 256:
                    text = texts[end].as_py()
                    rows.append(packed(np.array([place.setdefault(w, len(place)) for w in find(text)])))
                    size += len(text.encode())
                    end += 1
                n = end - at
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * n, pa.int64()), ids.slice(at, n), pa.array(rows, pa.binary()), pa.nulls(n, pa.int32()), *[pa.nulls(n, pa.binary()) for _ in range(3)]], _BLOCK)
                if size >= block_bytes:
                    yield from close()
                    block, size, place = block + 1, 0, {}
                at = end
        yield from close()
    return run


def _replay(ranks: str, replay_bytes: int):
    """Packed entries of blocks, sorted by part: the ids of their words, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        rows: list[tuple] = []
        size, last = 0, None

        def done() -> Iterator[pa.RecordBatch]:
            ids, counts = replay(list(number), ranks)
            begin = np.cumsum(counts) - counts
            for block, places, words in rows:
                n = counts[words]
                inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([places], pa.binary()), pa.array([packed(n)], pa.binary()),
                     pa.array([packed(ids[np.repeat(begin[words], n) + inside])], pa.binary())], ["in_block", "places", "counts", "ids"])

        for batch in batches:
            for part, block, places, sizes, words in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "places", "sizes", "words"))):
                # Equal words share a part: a new one begins when the part changes and enough has come together.
                if size >= replay_bytes and part != last or size >= 4 * replay_bytes:
                    yield from done()
                    number, rows, size = {}, [], 0
                last = part
                ends = np.cumsum(unpacked(sizes), dtype=np.int64).tolist()
                known = len(number)
                rows.append((block, places, np.array([number.setdefault(words[u:v], len(number)) for u, v in zip([0, *ends], ends)], np.int64)))
                size += len(places) + (len(words) if len(number) > known else 0)
        if rows:
            yield from done()
    return run


def _spell():
    """Documents of one block: their word numbers become ids."""
    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        of_word: dict[int, bytes] = {}
        for places, counts, ids in zip(*(words.column(c).to_pylist() for c in ("places", "counts", "ids"))):
            data, ends = unpacked(ids).tobytes(), (4 * np.cumsum(unpacked(counts), dtype=np.int64)).tolist()
            of_word.update(zip(unpacked(places).tolist(), [data[u:v] for u, v in zip([0, *ends], ends)]))
        table = np.array([of_word[i] for i in range(len(of_word))], object)
        out = []
        for refs in docs.column("refs").to_pylist():
            refs = unpacked(refs)
            out.append(b"".join(b"".join(table[refs[a:a + _SLICE]]) for a in range(0, len(refs), _SLICE)))
        return pa.table({"doc_id": docs.column("doc_id"), "ids": pa.array(out, pa.binary())})
    return run


def encode(docs: DataFrame, ranks: str = RANKS, block_bytes: int = BLOCK_BYTES, replay_bytes: int = REPLAY_BYTES) -> DataFrame:
    """``doc_id, ids``: one row per row of ``docs``; ids as little-endian unsigned 32-bit integers.

    Ids are those of the library for the same ranks and pattern, without
    special tokens.  Null counts as empty; an empty text has no ids; null or
    repeated doc_ids keep their rows; an empty table gives no rows; further
    columns are not read.  A word or text of any length is encoded whole.
    """
    spark = docs.sparkSession
    short_batches(spark)
    id_type = docs.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    arrow_id = to_arrow_type(id_type)
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("doc_id", id_type), T.StructField("refs", T.BinaryType()), T.StructField("part", T.IntegerType()),
                           *[T.StructField(c, T.BinaryType()) for c in ("places", "sizes", "words")]])
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = docs.select("doc_id", content(F.col("text")).alias("text")).mapInArrow(_split(block_bytes, 4 * buckets, arrow_id), schema)
    table = f"replay_blocks_{uuid.uuid4().hex}"
    made.write.format("parquet").option("compression", "zstd").bucketBy(buckets, "block").saveAsTable(table)
    blocks = spark.table(table)
    coded = (blocks.where("part IS NOT NULL").select("part", "block", "places", "sizes", "words").repartition("part").sortWithinPartitions("part")
             .mapInArrow(_replay(ranks, replay_bytes), "in_block long, places binary, counts binary, ids binary"))
    return (blocks.where("part IS NULL").select("block", "doc_id", "refs").groupBy("block").cogroup(coded.groupBy("in_block"))
            .applyInArrow(_spell(), T.StructType([T.StructField("doc_id", id_type), T.StructField("ids", T.BinaryType())])))


def _decode(ranks: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = np.array(vocabulary(ranks)[0], object)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                back = []
                for ids in part.column("ids").to_pylist():
                    ids = np.frombuffer(ids or b"", "<u4")
                    back.append(b"".join(b"".join(tokens[ids[a:a + _SLICE]]) for a in range(0, len(ids), _SLICE)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(back, pa.binary())], [*names, "decoded"])
    return run


def decode(coded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``coded`` with ``decoded``, the bytes of its ``ids`` (null ids: none).  An id outside the vocabulary is an error."""
    names = [c for c in coded.columns if c != "decoded"]
    schema = T.StructType([coded.schema[c] for c in names] + [T.StructField("decoded", T.BinaryType())])
    return coded.select(*names).mapInArrow(_decode(ranks, names), schema)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return decode(encode(docs)).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
