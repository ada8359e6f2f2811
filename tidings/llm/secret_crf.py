"""Secret scan: fixed patterns, and a linear-chain conditional random field over tokens.

The field tags every token of a line begin, inside or outside of a secret.
Its features are the token's shape, its neighbours' words and shapes, and
features of the file.  It is trained here, on a bounded sample of documents
whose labels are the spans of the fixed patterns, and on the same documents
with secrets planted into them that the patterns miss: random strings of
several alphabets after phrases that are no assignments, and ordinary words
after the same phrases as counterexamples.  It is decoded by Viterbi.

A token is certainly outside in every best path when its margin for "outside"
exceeds what the transitions around it could win back.  Certain tokens cut the
chain exactly, so Viterbi only runs over the stretches between them.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import short_batches, staged

# Fixed by the contract of the query: patterns, least lengths, order of the kinds.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # of whole runs, those of 24 or more
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "crf")
_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: The training sample: documents with and without pattern spans, of so many bytes at most.
SAMPLE_DOCS = 400
SAMPLE_BYTES = 32_768
#: What is planted into a training document: how often, phrases before it, alphabets and lengths.
PLANTED = 3
LEADS = ("password is", "credential:", "the key", "auth", "bearer", "login with", "pwd", "private key", "use", "")
ALPHABETS = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0123456789",
             "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
PREFIXES = ("", "", "", "pat_", "sk-", "key_live_")
PLANTED_LENGTHS = (12, 44)
#: Candidates considered per document drawn.
_MARGIN = 4
#: Tokens around a span, or from a random place, that make a training line.
WINDOW = 12
EPOCHS, RATE, RIDGE = 80, 0.3, 1e-4
BUCKETS = 4096
#: Least length of a secret that the field adds.
LEAST_FIELD = 8
B, I, O = 0, 1, 2
_NEVER = -1e6

_CLASS = np.zeros(256, np.int64)  # 0 blank, 1 word part, 2 other mark
_CLASS[33:128] = 2
for _r in (range(48, 58), range(65, 91), range(97, 123), range(128, 256), map(ord, "_+/.-")):
    _CLASS[list(_r)] = 1
# Bits of what a byte is: lower, upper, digit, mark inside words, beyond ASCII, letter beyond hex, other mark.
_BITS = np.zeros(256, np.int64)
for _i, _r in enumerate((range(97, 123), range(65, 91), range(48, 58), map(ord, "_+/.-"), range(128, 256),
                         [*range(103, 123), *range(71, 91)], [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "_+/.-"])):
    _BITS[list(_r)] |= 1 << _i


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and not overlapping per kind."""
    out = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def secret_parts(text: str) -> list[tuple[int, int]]:
    """Spans of the secrets themselves (the value of an assignment), for the labels."""
    spans = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    spans += [(s, e) for s, k, e in base_spans(text) if k]
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if not out or s >= out[-1][1]:
            out.append((s, e))
    return out


FEATURES = 8


class Tokens:
    """Tokens of texts laid end to end: byte places, lines and feature numbers."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        kind = _CLASS[raw]
        begins = kind != 0
        begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        self.start = np.flatnonzero(begins)
        ends = kind != 0
        ends[:-1] &= (kind[1:] != kind[:-1]) | (kind[:-1] == 2)
        self.end = np.flatnonzero(ends) + 1
        size = np.array([len(t) + 1 for t in texts], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(size)])[:-1]
        self.text = np.searchsorted(self.offset, self.start, "right") - 1
        n = len(self.start)
        if not n:
            self.line, self.features = np.zeros(0, np.int64), np.zeros((0, FEATURES), np.int64)
            return
        self.line = np.cumsum(raw == 10)[self.start]
        bits = np.bitwise_or.reduceat(_BITS[raw] * (kind != 0), self.start)
        # Changes between letters and digits inside a token.
        digit = (raw >= 48) & (raw <= 57)
        turns = np.concatenate([[0], np.cumsum(digit[1:] != digit[:-1])])
        turns = turns[self.end - 1] - turns[self.start]
        length = np.searchsorted([1, 2, 4, 6, 8, 12, 16, 20, 24, 32, 40, 64], self.end - self.start, "right")
        shape = (length * 128 + bits) * 4 + np.searchsorted([1, 3, 6], turns, "right")
        # A word is its bytes in lower case, as a sum over places (collisions share a weight).
        low = raw | (((raw >= 65) & (raw <= 90)) * np.uint8(32))
        place = np.arange(len(raw)) - np.repeat(self.start, np.diff(np.concatenate([self.start, [len(raw)]]))) if self.start[0] == 0 else None
        if place is None:
            place = np.zeros(len(raw), np.int64)
            place[self.start[0]:] = np.arange(self.start[0], len(raw)) - np.repeat(self.start, np.diff(np.concatenate([self.start, [len(raw)]])))
        value = (low.astype(np.int64) + 1) * ((place * 2654435761 + 40503) & 0xFFFFF) * (kind != 0)
        word = (np.add.reduceat(value, self.start) * 2654435761 >> 7) & (BUCKETS - 1)
        digits = np.add.reduceat(digit.astype(np.int64), self.offset)
        marks = np.add.reduceat((kind == 2).astype(np.int64), self.offset)
        of_file = (np.searchsorted([0.005, 0.05, 0.2], digits / size, "right") * 4 + np.searchsorted([0.02, 0.08, 0.2], marks / size, "right"))[self.text]

        def near(values: np.ndarray, by: int, none: int) -> np.ndarray:
            """The value ``by`` tokens away on the same line."""
            out = np.full(n, none)
            if by < 0:
                same = self.line[-by:] == self.line[:by]
                out[-by:][same] = values[:by][same]
            else:
                same = self.line[:-by] == self.line[by:]
                out[:-by][same] = values[by:][same]
            return out

        columns = [shape, near(word, -1, BUCKETS), near(word, -2, BUCKETS), near(word, -3, BUCKETS), near(word, 1, BUCKETS),
                   near(shape, -1, SHAPES - 1), near(shape, 1, SHAPES - 1), of_file]
        self.features = np.column_stack([c + base for c, base in zip(columns, BASES)])


SHAPES = 13 * 128 * 4 + 1
_SIZES = (SHAPES, BUCKETS + 1, BUCKETS + 1, BUCKETS + 1, BUCKETS + 1, SHAPES, SHAPES, 16)
BASES = tuple(np.concatenate([[0], np.cumsum(_SIZES)])[:-1].tolist())
TOTAL = sum(_SIZES)


def planted(text: str, times: int = PLANTED) -> tuple[str, list[tuple[int, int]]]:
    """``text`` with secrets and counterexamples put between its words, and the places of the secrets.

    What is planted depends on the text alone.
    """
    gaps = [m.start() for m in re.finditer(r"(?<=[A-Za-z,.]) (?=[A-Za-z])", text)]
    if not gaps:
        return text, []
    rng = np.random.default_rng(zlib.crc32(text.encode()))
    words = [w for w in re.findall(r"[A-Za-z]{3,}", text[:4096])] or ["word"]
    out, spans, at, length = [], [], 0, 0
    for n, gap in enumerate(sorted({gaps[i] for i in rng.integers(0, len(gaps), 2 * times)})):
        lead = LEADS[rng.integers(0, len(LEADS))]
        value = words[rng.integers(0, len(words))]
        if n % 2 == 0:
            alphabet = ALPHABETS[rng.integers(0, len(ALPHABETS))]
            size = int(rng.integers(*PLANTED_LENGTHS, endpoint=True))
            if alphabet == ALPHABETS[0]:
                # Longer runs are the hex pattern's.
                size = min(size, 23)
            prefix = PREFIXES[rng.integers(0, len(PREFIXES))] if alphabet != ALPHABETS[0] else ""
            value = prefix + "".join(alphabet[i] for i in rng.integers(0, len(alphabet), size - 2)) + "7" + alphabet[-1 if alphabet[-1].isalnum() else 0]
        piece = text[at:gap] + " " + (lead + " " if lead else "")
        out.append(piece + value)
        if n % 2 == 0:
            spans.append((length + len(piece), length + len(piece) + len(value)))
        length += len(piece) + len(value)
        at = gap
    return "".join(out) + text[at:], spans


def training_lines(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers [lines, WINDOW * 2, FEATURES] and labels: around every labelled secret, and at even places elsewhere."""
    rows, labels = [], []
    width = 2 * WINDOW
    more = [planted(t) for t in texts]
    for text, secrets in [*((t, secret_parts(t)) for t in texts), *((t, sorted([*secret_parts(t), *added])) for t, added in more if added)]:
        data = text.encode()
        tokens = Tokens([data])
        n = len(tokens.start)
        if n < width:
            continue
        y = np.full(n, O)
        centres = list(range(WINDOW, n - WINDOW + 1, max(width, n // 4)))
        for s, e in secrets:
            a, b = len(text[:s].encode()), len(text[:e].encode())
            inside = np.flatnonzero((tokens.start < b) & (tokens.end > a))
            if len(inside):
                y[inside] = I
                y[inside[0]] = B
                centres.append(min(max(WINDOW, int(inside[0])), n - WINDOW))
        for c in centres:
            if y[c - WINDOW] != I:
                rows.append(tokens.features[c - WINDOW:c + WINDOW])
                labels.append(y[c - WINDOW:c + WINDOW])
    return (np.stack(rows), np.stack(labels)) if rows else (np.zeros((0, width, FEATURES), int), np.zeros((0, width), int))


class Field:
    """Weights of the chain: emissions [TOTAL, 3] and transitions [3, 3] (outside never goes to inside)."""

    def __init__(self):
        self.weights = np.zeros((TOTAL, 3), np.float64)
        self.moves = np.zeros((3, 3))
        self.moves[O, I] = _NEVER

    def fit(self, x: np.ndarray, y: np.ndarray) -> Field:
        """Maximum likelihood by gradient ascent; forward and backward passes run over all lines at once."""
        if not len(x):
            self.weights[BASES[0]:BASES[0] + SHAPES, O] = 1.0
            return self
        used, x = np.unique(x, return_inverse=True)
        x = x.reshape(*y.shape, FEATURES)
        w, a = np.zeros((len(used), 3)), np.zeros((3, 3))
        sum_w, sum_a = np.full_like(w, 1e-8), np.full_like(a, 1e-8)
        gold_w, gold_a = np.zeros_like(w), np.zeros_like(a)
        np.add.at(gold_w, (x.ravel(), np.repeat(y.ravel(), FEATURES)), 1)
        np.add.at(gold_a, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        ban = np.zeros((3, 3))
        ban[O, I] = _NEVER
        steps = y.shape[1]
        for _ in range(EPOCHS):
            e = w[x].sum(2)
            e[:, 0, I] += _NEVER
            m = a + ban
            forward, backward = [e[:, 0]], [np.zeros_like(e[:, 0])]
            for t in range(1, steps):
                forward.append(np.logaddexp.reduce(forward[-1][:, :, None] + m, axis=1) + e[:, t])
            for t in range(steps - 1, 0, -1):
                backward.append(np.logaddexp.reduce(m[None] + (e[:, t] + backward[-1])[:, None, :], axis=2))
            f, b = np.stack(forward, 1), np.stack(backward[::-1], 1)
            z = np.logaddexp.reduce(f[:, -1], axis=1)
            node = np.exp(f + b - z[:, None, None])
            pair = np.exp(f[:, :-1, :, None] + m + (e + b)[:, 1:, None, :] - z[:, None, None, None])
            expected = np.zeros_like(w)
            for k in range(FEATURES):
                for label in range(3):
                    expected[:, label] += np.bincount(x[:, :, k].ravel(), node[:, :, label].ravel(), len(used))
            step_w = gold_w - expected - RIDGE * len(x) * w
            step_a = gold_a - pair.sum((0, 1)) - RIDGE * len(x) * a
            sum_w += step_w ** 2
            sum_a += step_a ** 2
            w += RATE * step_w / np.sqrt(sum_w)
            a += RATE * step_a / np.sqrt(sum_a)
        self.weights[used] = w
        self.moves = a + ban
        return self

    def slack(self) -> float:
        """The most that transitions can win when one token's label is anything but outside.

        The other path keeps all further labels, except that an inside token
        after it becomes the beginning of a secret (counted by the caller).
        """
        m, worst = self.moves, 0.0
        for before in range(3):
            for label in (B, I):
                if m[before, label] <= _NEVER / 2:
                    continue
                for after in range(3):
                    if after != I:
                        worst = max(worst, m[before, label] + m[label, after] - m[before, O] - m[O, after])
                    for then in range(3):
                        if after == I:
                            worst = max(worst, m[before, label] + m[label, I] + m[I, then] - m[before, O] - m[O, B] - m[B, then])
        # At the ends of a line some of these moves are absent.
        return worst + 2 * float(np.abs(m[m > _NEVER / 2]).max())

    def tags(self, tokens: Tokens) -> np.ndarray:
        """The best labels of every token, line by line."""
        n = len(tokens.start)
        y = np.full(n, O)
        if not n:
            return y
        e = np.zeros((n, 3), np.float64)
        for k in range(FEATURES):
            e += self.weights[tokens.features[:, k]]
        again = np.zeros(n)
        again[:-1] = np.maximum(0, e[1:, I] - e[1:, B]) * (tokens.line[1:] == tokens.line[:-1])
        open_ = np.flatnonzero(e[:, O] - np.maximum(e[:, B], e[:, I]) <= self.slack() + again)
        if not len(open_):
            return y
        cuts = np.flatnonzero((np.diff(open_) > 1) | (np.diff(tokens.line[open_]) != 0)) + 1
        for run in np.split(open_, cuts):
            a, b = run[0], run[-1] + 1
            left = a > 0 and tokens.line[a - 1] == tokens.line[a]
            right = b < n and tokens.line[b] == tokens.line[b - 1]
            y[a:b] = self.viterbi(e[a:b], left, right)
        return y

    def viterbi(self, e: np.ndarray, after_outside: bool = False, before_outside: bool = False) -> np.ndarray:
        """Best labels of a stretch; its neighbours on the line, if any, are outside."""
        best = e[0] + (self.moves[O] if after_outside else np.array([0, _NEVER, 0.0]))
        back = []
        for row in e[1:]:
            score = best[:, None] + self.moves
            back.append(score.argmax(0))
            best = score.max(0) + row
        if before_outside:
            best = best + self.moves[:, O]
        path = [int(best.argmax())]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        return np.array(path[::-1])


def field_spans(field: Field, texts: list[bytes]) -> list[list[tuple[int, int]]]:
    """Byte spans of the tagged secrets of every text."""
    tokens = Tokens(texts)
    y = field.tags(tokens)
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    tagged = np.flatnonzero(y != O)
    for t in tagged:
        i, base = tokens.text[t], tokens.offset[tokens.text[t]]
        s, e = int(tokens.start[t] - base), int(tokens.end[t] - base)
        if y[t] == I and out[i]:
            out[i][-1] = (out[i][-1][0], e)
        else:
            out[i].append((s, e))
    return out


def all_spans(text: str, data: bytes, tagged: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Pattern spans, and tagged ones of some length that meet none of them, by start and kind (code points)."""
    spans = base_spans(text)
    extra = []
    for s, e in tagged:
        a = len(data[:s].decode())
        b = a + len(data[s:e].decode())
        if b - a >= LEAST_FIELD and all(b <= s0 or a >= e0 for s0, _, e0 in spans):
            extra.append((a, 3, b))
    return sorted(spans + extra)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_PIECES = 1 << 20
_RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            at = 0
            while at < len(texts):
                data, size = [], 0
                while at + len(data) < len(texts) and (not data or size < _PIECES):
                    data.append(texts[at + len(data)].encode())
                    size += len(data[-1])
                rows = []
                for doc_id, text, raw, tagged in zip(ids[at:], texts[at:], data, field_spans(field, data)):
                    spans = all_spans(text, raw, tagged)
                    base = [x for x in spans if x[1] < 3]
                    n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                    rows.append((doc_id, *n, hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.string()] * 2)],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
                at += len(data)
    return run


def training_sample(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Texts to learn from: the first by a hash, with and without something like a pattern span.

    Only hashes below a threshold are ranked: some ``_MARGIN`` times as many
    rows as are drawn, whatever the size of the table, and the smallest always.
    """
    likely = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"""
    usable = docs.where(F.octet_length("text").between(1, SAMPLE_BYTES) & F.col("doc_id").isNotNull())
    keyed = usable.select("doc_id", "text", F.shiftrightunsigned(F.xxhash64("text"), 1).alias("h"))
    keys = staged(keyed.select("doc_id", "h", F.col("text").rlike(likely).alias("hit")), "secret_keys")
    reach = keys.groupBy(F.col("hit").alias("r_hit")).agg(F.min("h").alias("least"), F.count("*").alias("n")).select(
        "r_hit", "least", (F.least(F.lit(1.0), F.lit(float(_MARGIN * sample_docs)) / F.col("n")) * float(2**63 - 1024)).cast("long").alias("reach"))
    order = Window.partitionBy("hit").orderBy("h", "doc_id")
    ids = staged(keys.join(reach, F.col("hit") == F.col("r_hit")).where("h <= reach OR h = least").select("doc_id", "h", "hit").distinct()
                 .withColumn("r", F.row_number().over(order)).where(F.col("r") <= sample_docs).select("doc_id", "h"), "secret_sample")
    return keyed.join(ids, ["doc_id", "h"], "left_semi").select("h", "text")


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Field:
    """The field trained on the sample; its lines are made on the executors."""
    width = 2 * WINDOW

    def lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for h, text in zip(frame["h"], frame["text"]):
                x, y = training_lines([text])
                if len(x):
                    yield pd.DataFrame({"h": h, "x": list(x.reshape(len(x), -1)), "y": list(y)})

    made = training_sample(docs, sample_docs).mapInPandas(lines, "h long, x array<int>, y array<int>")
    # At most 2 * SAMPLE_DOCS documents of SAMPLE_BYTES bytes.
    rows = made.dropDuplicates(["h", "x"]).orderBy("h", "x").collect()
    x = np.array([r["x"] for r in rows], int).reshape(len(rows), width, FEATURES)
    return Field().fit(x, np.array([r["y"] for r in rows], int).reshape(len(rows), width))


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: one row per row of ``docs``.

    Null counts as empty: no spans.  Null or repeated ids keep their rows; an
    empty table gives no rows; further columns are not read.
    """
    spark = docs.sparkSession
    short_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_scan(spark.sparkContext.broadcast(field)), _RESULT)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return scan(docs, fit(docs))
