"""Fill-in-middle transformation by displacement scatter, and its inverse.

The texts of a batch lie in one byte buffer.  Scanning it gives the token
starts, of which a rank / select index finds each document's two cuts.  A cut
document is three spans that move; every span adds the change of displacement
to a difference array at its first byte.  The cumulative sum is the shift of
every byte, and one numpy scatter builds all outputs of the batch, sentinels
between the spans.  The inverse finds the sentinels, which no cut text
contains itself, and gathers the bytes back by the shifts of the restored
order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import short_batches
from .token_cache import content

SEED = 1
PLAIN_FROM = 90
SPM_BELOW = 20
PLAIN, PSM, SPM = "plain", "psm", "spm"
_FORMS = np.array([PLAIN, PSM, SPM], object)
#: A batch's buffer (a longer text is a buffer of its own), and the stretch whose shifts exist at once.
BUFFER_BYTES = 4 << 20
WINDOW = 1 << 20
MARK = 3


class Marks:
    """Rank and select over marked bytes, window by window."""

    def __init__(self, marked: np.ndarray):
        self.marked = marked
        per_window = [np.count_nonzero(marked[a:a + WINDOW]) for a in range(0, len(marked), WINDOW)]
        self.total = np.concatenate([[0], np.cumsum(per_window, dtype=np.int64)])

    def before(self, places: np.ndarray) -> np.ndarray:
        """How many marks lie before each place."""
        out = np.full(len(places), self.total[-1])
        window = places // WINDOW
        for w in np.unique(window[places < len(self.marked)]):
            part = self.marked[w * WINDOW:(w + 1) * WINDOW]
            upto = np.concatenate([[0], np.cumsum(part, dtype=np.int64)])
            here = window == w
            out[here] = self.total[w] + upto[np.minimum(places[here] - w * WINDOW, len(part))]
        return out

    def place(self, numbers: np.ndarray) -> np.ndarray:
        """Where the marks with these numbers (from 0) are."""
        out = np.zeros(len(numbers), np.int64)
        window = np.searchsorted(self.total, numbers, "right") - 1
        for w in np.unique(window):
            here = window == w
            out[here] = w * WINDOW + np.flatnonzero(self.marked[w * WINDOW:(w + 1) * WINDOW])[numbers[here] - self.total[w]]
        return out


def shifts(size: int, places: np.ndarray, shift: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Windows (from, to, shift of every byte): from ``places[k]`` on, ``shift[k]`` holds.  Of equal places the last counts."""
    change = np.diff(shift, prepend=0)
    carry = 0
    window = places // WINDOW
    for a in range(0, size, WINDOW):
        b = min(size, a + WINDOW)
        here = window == a // WINDOW
        difference = np.zeros(b - a, np.int64)
        np.add.at(difference, places[here] - a, change[here])
        difference[0] += carry
        moved = np.cumsum(difference)
        carry = moved[-1]
        yield a, b, moved


def sentinels(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of <P>, <S> and <M> inside single texts, and the text of each."""
    if len(raw) < MARK:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    middle = raw[1:-1]
    at = np.flatnonzero((raw[:-2] == ord("<")) & (raw[2:] == ord(">")) & ((middle == ord("P")) | (middle == ord("S")) | (middle == ord("M"))))
    owner = np.searchsorted(offsets, at, "right") - 1
    inside = at + MARK <= offsets[owner + 1]
    return at[inside], owner[inside]


def scan(raw: np.ndarray, offsets: np.ndarray) -> tuple[Marks, Marks]:
    """Starts of tokens (a run of ASCII letters, or one other code point) and of code points."""
    head = (raw & 0xC0) != 0x80
    letter = ((raw | 32) - np.uint8(97)) < 26
    start = head.copy()
    start[1:] &= ~(letter[1:] & letter[:-1])
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[first] = True
    return Marks(start), Marks(head)


def scatter(raw: np.ndarray, offsets: np.ndarray, h: list[np.ndarray], plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW):
    """n, form code, prefix_chars, middle_chars, output offsets and output bytes of all texts of a buffer."""
    begin, end = offsets[:-1], offsets[1:]
    tokens, points = scan(raw, offsets)
    first = tokens.before(begin)
    n = tokens.before(end) - first
    a, b = h[0] % (n + 1), h[1] % (n + 1)
    cuts = []
    for k in (np.minimum(a, b), np.maximum(a, b)):
        cut = end.copy()
        inner = k < n
        cut[inner] = tokens.place(first[inner] + k[inner])
        cuts.append(cut)
    left, right = cuts
    marked = np.zeros(len(n), bool)
    marked[sentinels(raw, offsets)[1]] = True
    whole = (n == 0) | marked | (h[2] % 100 >= plain_from)
    form = np.where(whole, 0, np.where(h[3] % 100 < spm_below, 2, 1))
    to = np.concatenate([[0], np.cumsum(end - begin + np.where(whole, 0, 3 * MARK))])
    out = np.empty(to[-1], np.uint8)
    base, p, s = to[:-1], left - begin, end - right
    spm = form == 2
    # Where the spans begin in the output.
    prefix = np.where(whole, base, base + MARK + np.where(spm, s + MARK, 0))
    suffix = np.where(whole, base + (right - begin), base + MARK + np.where(spm, 0, p + MARK))
    centre = np.where(whole, base + p, base + p + s + 3 * MARK)
    places = np.column_stack([begin, left, right]).ravel()
    moves = np.column_stack([prefix - begin, centre - left, suffix - right]).ravel()
    kept = places < len(raw)
    for u, v, shift in shifts(len(raw), places[kept], moves[kept]):
        out[np.arange(u, v) + shift] = raw[u:v]
    for spot, name in ((prefix, b"<P>"), (suffix, b"<S>"), (centre, b"<M>")):
        for k, byte in enumerate(name):
            out[spot[~whole] - MARK + k] = byte
    begins = points.before(begin)
    lefts = points.before(left)
    return n, form, lefts - begins, points.before(right) - lefts, to, out


def gather(raw: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of the texts that ``scatter`` made these outputs of."""
    begin, end = offsets[:-1], offsets[1:]
    cut = form > 0
    at, owner = sentinels(raw, offsets)
    at = at[cut[owner]]
    if len(at) != MARK * np.count_nonzero(cut):
        raise ValueError("a psm or spm output holds three sentinels")
    found = np.column_stack([begin] * 3)
    found[cut] = at.reshape(-1, 3)
    # First and second span as they lie in the output; plain texts are one prefix.
    one = np.where(cut, found[:, 1] - found[:, 0] - MARK, end - begin)
    two = np.where(cut, found[:, 2] - found[:, 1] - MARK, 0)
    three = np.where(cut, end - found[:, 2] - MARK, 0)
    spm = form == 2
    p, s = np.where(spm, two, one), np.where(spm, one, two)
    to = np.concatenate([[0], np.cumsum(one + two + three)])
    base = to[:-1]
    first = np.where(cut, found[:, 0] + MARK, begin)
    second, third = np.where(cut, found[:, 1] + MARK, end), np.where(cut, found[:, 2] + MARK, end)
    places = np.column_stack([base, base + p, base + p + three]).ravel()
    sources = np.column_stack([np.where(spm, second, first), third, np.where(spm, first, second)]).ravel()
    back = np.empty(to[-1], np.uint8)
    kept = places < to[-1]
    for u, v, shift in shifts(len(back), places[kept], (sources - places)[kept]):
        back[u:v] = raw[np.arange(u, v) + shift]
    return to, back


def _buffers(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows: from, to, their texts' bytes and offsets."""
    texts = batch.column(name).cast(pa.large_string())
    _, places, data = texts.buffers()
    places = np.frombuffer(places, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(places, places[at] + BUFFER_BYTES, "right")) - 1)
        raw = np.frombuffer(data, np.uint8, places[end] - places[at], places[at]) if places[end] > places[at] else np.zeros(0, np.uint8)
        yield at, end, raw, places[at:end + 1] - places[at]
        at = end


def _strings(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.string())


def _scatter(plain_from: int, spm_below: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = [batch.column(f"h{k}").to_numpy(zero_copy_only=False) for k in (1, 2, 3, 4)]
            for at, end, raw, offsets in _buffers(batch, "text"):
                n, form, prefix, middle, to, out = scatter(raw, offsets, [x[at:end] for x in h], plain_from, spm_below)
                plain = form == 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, end - at), pa.array(n, pa.int64()), pa.array(_FORMS[form], pa.string()),
                     pa.array(prefix, pa.int64(), mask=plain), pa.array(middle, pa.int64(), mask=plain), _strings(to, out)],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def _gather(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = {PSM: 1, SPM: 2}
            form = np.array([code.get(x, 0) for x in batch.column("form").to_pylist()], np.int64)
            for at, end, raw, offsets in _buffers(batch, "output"):
                to, back = gather(raw, offsets, form[at:end])
                part = batch.slice(at, end - at)
                yield pa.RecordBatch.from_arrays([*part.columns, _strings(to, back)], [*names, "restored"])
    return run


def hashes(doc_id: Column, seed: int = SEED) -> list[Column]:
    """The first four 8-digit groups of the seeded id's sha256; a null id has no digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: one row per row of ``docs``.

    Null counts as empty; empty texts, texts holding a sentinel, and
    ``100 - plain_from`` in 100 of the rest stay as they are (plain, null
    lengths); ``spm_below`` in 100 of the others put the suffix first.  Rows
    equal in doc_id and text get the same output; null ids share one draw; an
    empty table gives no rows; further columns are not read.
    """
    short_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), *T._parse_datatype_string(
        "n long, form string, prefix_chars long, middle_chars long, output string").fields])
    rows = docs.select("doc_id", content(F.col("text")).alias("text"), *hashes(F.col("doc_id"), seed))
    return rows.mapInArrow(_scatter(plain_from, spm_below), schema)


def restore(done: DataFrame) -> DataFrame:
    """``done`` with ``restored``, the text rebuilt from ``output`` and ``form`` alone (a null output is empty, a null form plain)."""
    names = [c for c in done.columns if c != "restored"]
    schema = T.StructType([done.schema[c] for c in names] + [T.StructField("restored", T.StringType())])
    return done.select(*names).withColumn("output", content(F.col("output"))).mapInArrow(_gather(names), schema)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return restore(fill_in_middle(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"))
