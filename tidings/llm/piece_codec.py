"""SentencePiece encoding and decoding with a max-plus parallel scan over chunks.

A piece sequence is the encoding of its text exactly if every piece encodes to
itself and every two neighbours, joined, encode to those two (merges are local,
so a merge across a border would also happen in the two pieces alone).  The
encoding is thus the one path of weight 0 in a max-plus lattice whose states
are "the last piece and where it ends", with weight minus infinity between
neighbours that do not fit.

Giant documents are cut into chunks of a fixed number of characters, without
regard to words.  Each chunk yields the transfer matrix between the states at
its two borders (only its entries of weight 0 are stored).  The matrices are
combined associatively in a tree, which fixes the state at every border, and
each chunk is then backtraced by itself.  Inside a chunk, everything between
the first and the last word start is a factor of rank one: whatever the entry
state, one path leads through, and the SentencePiece library gives it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import short_batches, staged
from .token_cache import MODEL, processor

SPACE = "▁"
CHUNK_CHARS = 32_768
FAN_IN = 64
START = (0, -1)
UNKNOWN = -2


class Lattice:
    """The pieces of a model, which neighbours fit, and paths through a stretch of text."""

    def __init__(self, model: str):
        self.sp = sp = processor(model)
        plain = [i for i in range(len(sp)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in plain}
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        self.pieces = [sp.id_to_piece(i) for i in range(len(sp))]
        self.longest = max(map(len, self.ids))
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.word_starts = not any(a != SPACE and b == SPACE for p in self.ids for a, b in zip(p, p[1:]))
        self.raw = [b"" if sp.is_control(i) else bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(SPACE, " ").encode()
                    for i, p in enumerate(self.pieces)]
        self.fits = cache(self._fits)
        self.whole = cache(lambda p: self.merged(p) == [p])

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text: merge the best-scored neighbours, leftmost first."""
        parts = list(text)
        while True:
            best = max(((self.score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score), default=None)
            if best is None:
                return parts
            i = -best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def _fits(self, left: int, right: int) -> bool:
        if left < 0 or right < 0:  # a border, or a character without piece, which never merges
            return True
        a, b = self.pieces[left], self.pieces[right]
        return self.merged(a + b) == [a, b]

    def from_here(self, s: str, at: int) -> Iterator[tuple[int, int]]:
        """(end, piece) of every piece that starts at ``at``; a lone character without piece counts as one."""
        known = False
        for end in range(at + 1, min(len(s), at + self.longest) + 1):
            p = s[at:end]
            if p in self.ids and self.whole(p):
                known |= end == at + 1
                yield end, self.ids[p]
        if not known:
            yield at + 1, UNKNOWN

    def forward(self, s: str, starts: dict[tuple[int, int], int], stop: int) -> tuple[dict, dict]:
        """Follow bit sets of entry states from ``starts`` (state: bits) until pieces end at or after ``stop``.

        Returns the states at the border ``stop`` with their bits, and for
        every state the states before it.
        """
        open_, back, done = {}, {}, {}
        for (end, piece), bits in starts.items():
            (done if end >= stop else open_.setdefault(end, {}))[(end, piece) if end >= stop else piece] = bits
        for at in range(min(open_, default=stop), stop):
            here = open_.pop(at, None)
            if not here:
                continue
            for end, piece in self.from_here(s, at):
                for before, bits in here.items():
                    if self.fits(before, piece):
                        if end >= stop:
                            done[end, piece] = done.get((end, piece), 0) | bits
                        else:
                            then = open_.setdefault(end, {})
                            then[piece] = then.get(piece, 0) | bits
                        back.setdefault((end, piece), []).append((at, before))
        return done, back

    def trace(self, s: str, entry: tuple[int, int], leave: tuple[int, int], stop: int) -> list[int]:
        """Pieces of the path from state ``entry`` to state ``leave`` at the border ``stop``."""
        _, back = self.forward(s, {entry: 1}, stop)
        path, state = [], leave
        while state != entry:
            path.append((state[1], state[0]))
            state = back[state][0]
        ids, at = [], entry[0]
        for piece, end in reversed(path):
            ids += [piece] if piece >= 0 else [self.byte_ids[b] for b in s[at:end].encode()]
            at = end
        return ids

    def borders(self, s: str, a: int, b: int) -> tuple[int, int] | None:
        """First and last word start in a < i < b (a space after something else), where every path has a border."""
        if not self.word_starts:
            return None
        first = next((i for i in range(a + 1, b) if s[i] == SPACE and s[i - 1] != SPACE), None)
        if first is None:
            return None
        return first, next(i for i in range(b - 1, a, -1) if s[i] == SPACE and s[i - 1] != SPACE)

    def entries(self, s: str, a: int) -> list[tuple[int, int]]:
        """States possible at border ``a`` > 0: pieces that start before it and end at or after it."""
        return [(end, piece) for p in range(max(0, a - self.longest), a) for end, piece in self.from_here(s, p) if end >= a]

    def transfer(self, s: str, a: int, b: int, first: bool, last: bool) -> list[tuple]:
        """Entries of weight 0 of the chunk's matrix: (state at a, state at b); ends are relative to the border.

        ``s`` holds the chunk and its surroundings; the first chunk is entered
        by START alone, the last is left where the text ends.
        """
        states = [START] if first else self.entries(s, a)
        begins = {((a + e) if first else e, t): 1 << i for i, (e, t) in enumerate(states)}
        cut = self.borders(s, a, b)
        if cut is None:
            done, _ = self.forward(s, begins, b)
        else:
            head, _ = self.forward(s, begins, cut[0])
            reach = 0
            for (end, _), bits in head.items():
                reach |= bits if end == cut[0] else 0
            done, _ = self.forward(s, {(cut[1], -1): reach}, b)
        return [((e, t) if first else (e - a, t), (end - b, piece))
                for i, (e, t) in enumerate(states) for (end, piece), bits in done.items()
                if bits >> i & 1 and (not last or end == b)]

    def backtrace(self, s: str, a: int, b: int, entry: tuple[int, int], leave: tuple[int, int]) -> list[int]:
        """Piece ids of the chunk (pieces that start in it), given the states at its borders."""
        entry, leave = (a + entry[0], entry[1]), (b + leave[0], leave[1])
        cut = self.borders(s, a, b)
        if cut is None:
            return self.trace(s, entry, leave, b)
        done, _ = self.forward(s, {entry: 1}, cut[0])
        head = self.trace(s, entry, next(x for x in done if x[0] == cut[0]), cut[0])
        inner = self.sp.encode(s[cut[0] + 1:cut[1]]) if cut[1] > cut[0] else []
        if cut[1] == cut[0] + 1:
            inner = [self.ids[SPACE]]
        return head + inner + self.trace(s, (cut[1], -1), leave, b)

    def decode(self, ids) -> str:
        """Text of piece ids: bytes joined, without the space that encoding puts in front."""
        raw = b"".join([self.raw[i] for i in ids])
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def marked(text: str) -> str:
    """The text as the lattice sees it: a space in front, spaces as the space piece."""
    return (SPACE + text).replace(" ", SPACE) if text else ""


_RESULT = "doc_id long, text_crc32 long, space_mark boolean, n_tokens int, ids array<int>, decoded string"


def _lists(rows: list) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int64)
    flat = np.fromiter((i for r in rows for i in r), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _whole(model: str):
    """Documents of one chunk: START to the end of the text in one step, then decoded again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = Lattice(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = grid.sp.encode(part.column("text").to_pylist(), num_threads=1)
                back = [grid.decode(r) for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_crc32"), part.column("space_mark"), pa.array([len(r) for r in rows], pa.int32()), _lists(rows), pa.array(back, pa.string())],
                    ["doc_id", "text_crc32", "space_mark", "n_tokens", "ids", "decoded"])
    return run


def _chunks(chunk: int, reach: int):
    """Cut giant documents: chunk ``j`` of ``n`` with ``reach`` characters around it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, doc_id, crc, mark, text in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "text_crc32", "space_mark", "text"))):
                s = marked(text)
                n = -(-len(s) // chunk)
                for j in range(n):
                    a, b = j * chunk, min(len(s), (j + 1) * chunk)
                    left = max(0, a - reach)
                    yield pa.RecordBatch.from_pylist([{"key": key, "doc_id": doc_id, "text_crc32": crc, "space_mark": mark, "j": j, "n": n, "a": a - left, "b": b - left, "s": s[left:b + reach]}],
                                                     schema=_CHUNK)
    return run


_CHUNK = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("text_crc32", pa.int64()), ("space_mark", pa.bool_()), ("j", pa.int32()), ("n", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("s", pa.string())])
_STATE = pa.list_(pa.int32())
_MATRIX = pa.schema([("key", pa.int64()), ("level_j", pa.int32()), ("entries", pa.list_(_STATE))])
MATRIX_DDL = "key long, level_j int, entries array<array<int>>"


def _transfer(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = Lattice(model)
        for batch in batches:
            for r in batch.to_pylist():
                m = grid.transfer(r["s"], r["a"], r["b"], r["j"] == 0, r["j"] == r["n"] - 1)
                yield pa.RecordBatch.from_pylist([{"key": r["key"], "level_j": r["j"], "entries": [[*x, *y] for x, y in m]}], schema=_MATRIX)
    return run


def _pairs(entries) -> list[tuple]:
    return [((e[0], e[1]), (e[2], e[3])) for e in entries]


def product(left: list[tuple], right: list[tuple]) -> list[tuple]:
    """Max-plus product of two matrices with weights 0 and minus infinity."""
    after: dict = {}
    for x, y in right:
        after.setdefault(x, []).append(y)
    return sorted({(x, z) for x, y in left for z in after.get(y, ())})


def _compose(key, pdf):
    import pandas as pd
    pdf = pdf.sort_values("level_j")
    total = None
    for entries in pdf["entries"]:
        total = _pairs(entries) if total is None else product(total, _pairs(entries))
    return pd.DataFrame({"key": [key[0]], "level_j": [key[1]], "entries": [[[*map(int, (*x, *y))] for x, y in total]]})


def _descend(key, pdf):
    """Fix the states at the borders inside a group whose two outer states are known."""
    import pandas as pd
    pdf = pdf.sort_values("level_j")
    matrices = [_pairs(e) for e in pdf["entries"]]
    entry, leave = tuple(map(int, pdf["entry"].iloc[0])), tuple(map(int, pdf["leave"].iloc[0]))
    reached = [{entry}]
    for m in matrices:
        reached.append({y for x, y in m if x in reached[-1]})
    states = [leave]
    for m, before in zip(reversed(matrices), reversed(reached[:-1])):
        states.append(next(x for x, y in m if y == states[-1] and x in before))
    states.reverse()
    return pd.DataFrame({"key": key[0], "level_j": pdf["level_j"].to_list(), "entry": [list(x) for x in states[:-1]], "leave": [list(x) for x in states[1:]]})


def border_states(matrices: DataFrame, most: int, fan_in: int = FAN_IN) -> DataFrame:
    """Entry and leave state of every chunk, by a tree of products and its descent.

    ``most`` is the largest number of chunks of a document; each group joins at
    most ``fan_in`` matrices.
    """
    parent = F.expr(f"level_j div {fan_in}").cast("int")
    levels = [matrices]
    while most > 1:
        levels.append(staged(levels[-1].groupBy("key", parent.alias("p")).applyInPandas(_compose, MATRIX_DDL), "codec_level"))
        most = -(-most // fan_in)
    top = levels[-1].select("key", "level_j", F.expr("slice(entries[0], 1, 2)").alias("entry"), F.expr("slice(entries[0], 3, 2)").alias("leave"))
    for below in reversed(levels[:-1]):
        joined = below.withColumn("p", parent).join(top.withColumnRenamed("level_j", "p"), ["key", "p"])
        top = staged(joined.groupBy("key", "p").applyInPandas(_descend, "key long, level_j int, entry array<int>, leave array<int>"), "codec_states")
    return top


def _backtrace(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = Lattice(model)
        for batch in batches:
            for r in batch.to_pylist():
                ids = grid.backtrace(r["s"], r["a"], r["b"], tuple(r["entry"]), tuple(r["leave"]))
                yield pa.RecordBatch.from_arrays([pa.array([r["key"]]), pa.array([r["j"]], pa.int32()), _lists([ids])], ["key", "j", "ids"])
    return run


def _decode(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = Lattice(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                back = [grid.decode(r) for r in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(back, pa.string())], [*part.schema.names, "decoded"])
    return run


def encode_decode(docs: DataFrame, model: str = MODEL, chunk_chars: int = CHUNK_CHARS, fan_in: int = FAN_IN) -> DataFrame:
    """``doc_id, text_crc32, space_mark, n_tokens, ids, decoded``: one row per row of ``docs``.

    Ids are those of the SentencePiece library, without begin or end.
    ``decoded`` is the text of the ids: the text itself, except that the
    library's space mark (U+2581) comes back as a space.  ``text_crc32`` is the
    checksum of the given text, to compare the round trip with; ``space_mark``
    tells that the text holds that sign.  Null counts as
    empty; an empty text has no ids; null or repeated ids keep their rows; an
    empty table gives no rows; further columns are not read.
    """
    short_batches(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.contains(text, F.lit(SPACE)).alias("space_mark"), text.alias("text"))
    # The mark in front makes a text one character longer than its chunk may be.
    small = F.length("text") < chunk_chars
    whole = rows.where(small).mapInArrow(_whole(model), _RESULT)
    reach = 2 * Lattice(model).longest
    # The key only has to be distinct in the table written here.
    cut = rows.where(~small).withColumn("key", F.monotonically_increasing_id()).mapInArrow(
        _chunks(chunk_chars, reach), "key long, doc_id long, text_crc32 long, space_mark boolean, j int, n int, a int, b int, s string")
    chunks = staged(cut, "codec_chunks")
    most = chunks.agg(F.max("n")).first()[0] or 0
    work = chunks.select("key", "j", "n", "a", "b", "s")
    matrices = staged(work.mapInArrow(_transfer(model), MATRIX_DDL), "codec_matrices")
    states = border_states(matrices, most, fan_in).withColumnRenamed("level_j", "j")
    traced = work.join(states, ["key", "j"]).mapInArrow(_backtrace(model), "key long, j int, ids array<int>")
    joined = traced.groupBy("key").agg(F.expr("flatten(transform(array_sort(collect_list(struct(j, ids))), x -> x.ids))").alias("ids"))
    heads = chunks.where("j = 0").select("key", "doc_id", "text_crc32", "space_mark")
    giant = heads.join(joined, "key").select("doc_id", "text_crc32", "space_mark", F.size("ids").alias("n_tokens"), "ids").mapInArrow(_decode(model), _RESULT)
    return whole.unionByName(giant)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Ids of every document; ``same`` tells that decoding gave the given text back.

    ``space_mark`` tells that the text holds U+2581, which the library reads as a space: such a text cannot come back.
    """
    return encode_decode(docs).select("doc_id", "n_tokens", "ids", (F.crc32(F.col("decoded").cast("binary")) == F.col("text_crc32")).alias("same"), "space_mark")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage of the pipeline: ids and round trip of every document."""
    return query(spark, docs)
