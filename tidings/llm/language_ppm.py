"""Language identification by prediction by partial matching (PPM).

For every language a tree of byte contexts up to ``ORDER`` bytes is counted on
a bounded sample of labelled documents and then frozen.  The code length of a
byte follows PPM with escape method C: a byte seen after the context costs
-log2(count / (total + distinct)), else the escape -log2(distinct / (total +
distinct)) is paid and the next shorter context is asked, down to 8 bits for a
byte never seen.  The language with the shortest code of the whole text wins.

A code length depends on the last ORDER + 1 bytes alone, so the frozen trees
are kept as sorted tables of byte strings with the code length in every
language, and texts are scored by table look-ups in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import short_batches, staged

ORDER = 4
#: The fitting sample: so many documents per language, of so many bytes at most.
#: Of a language with fewer short documents, pieces of that size of its longer ones are taken.
SAMPLE_DOCS = 300
SAMPLE_BYTES = 32_768
UNKNOWN = "und"
FOLDS = 5
_PAD = b"\n" * ORDER
_PIECE = 1 << 20
#: A letter is a code point of Unicode category L, in fitting and in prediction.
_LETTER = r"\p{L}"
#: Documents considered per document drawn, so that ranking them stays small work.
_MARGIN = 4
_ADDED = "held_out boolean, lang_pred string, score double, bits_per_byte double"


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def codes(raw: np.ndarray, order: int) -> np.ndarray:
    """For every position from ORDER on, the last order + 1 bytes as one number."""
    out = raw[ORDER:].astype(np.int64)
    for back in range(1, order + 1):
        out |= raw[ORDER - back:len(raw) - back].astype(np.int64) << (8 * back)
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            raw = np.frombuffer(_PAD + text.encode(), np.uint8)
            for order in range(ORDER + 1):
                grams, n = np.unique(codes(raw, order), return_counts=True)
                size = len(grams)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * size, pa.string()), pa.array([order] * size, pa.int32()), pa.array(grams), pa.array(n, pa.int64())],
                    ["lang", "order", "gram", "n"])


def training_sample(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """lang, text of the documents to learn from: of every language the first by a hash of id and text, short ones before pieces of long ones.

    Only hashes below a language's threshold are ranked: some ``_MARGIN`` times
    as many rows as are drawn, whatever the size of the table, and the
    smallest hash always, so that every language is learned.
    """
    size = F.octet_length("text")
    usable = (docs.where(F.col("lang").isNotNull() & F.col("text").rlike(_LETTER) & (fold(F.col("doc_id")) != 0))
              .select("lang", "text", (size > SAMPLE_BYTES).alias("long"), F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1).alias("h")))
    keys = staged(usable.select("lang", "long", "h"), "language_keys")
    reach = keys.groupBy("lang", "long").agg(F.count("*").alias("n"), F.min("h").alias("least")).select(
        F.col("lang").alias("r_lang"), F.col("long").alias("r_long"),
        "least", (F.least(F.lit(1.0), F.lit(float(_MARGIN * sample_docs)) / F.col("n")) * float(2**63 - 1024)).cast("long").alias("reach"))
    near = keys.join(reach, (F.col("lang") == F.col("r_lang")) & (F.col("long") == F.col("r_long"))).where("h <= reach OR h = least")
    order = Window.partitionBy("lang").orderBy("long", "h")
    ids = staged(near.select("lang", "long", "h").distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= sample_docs)
                 .select("lang", "h"), "language_sample")
    # Characters of at most 4 bytes; where the piece begins is drawn by the hash.
    chars = SAMPLE_BYTES // 4
    start = F.col("h") % F.greatest(F.length("text") - chars, F.lit(1)) + 1
    piece = F.when(F.col("long"), F.col("text").substr(start.cast("int"), F.lit(chars))).otherwise(F.col("text"))
    return usable.join(ids, ["lang", "h"], "left_semi").dropDuplicates(["lang", "h"]).select("lang", piece.alias("text"))


class Model:
    """Frozen code lengths: tables[k] holds the byte strings of length k + 1 seen in any language."""

    def __init__(self, counts):
        """``counts``: data frame lang, order, gram, n of the sample."""
        self.langs = sorted(counts["lang"].unique())
        place = {x: i for i, x in enumerate(self.langs)}
        self.grams, self.cost, self.escape, self.slots = [], [], [], []
        self.contexts, self.context_slots = [], []
        for order in range(ORDER + 1):
            part = counts[counts["order"] == order]
            grams = np.unique(part["gram"].to_numpy(np.int64))
            seen = np.zeros((len(grams), len(self.langs)))
            seen[np.searchsorted(grams, part["gram"].to_numpy(np.int64)), part["lang"].map(place).to_numpy(np.int64)] = part["n"].to_numpy()
            contexts, context = np.unique(grams >> 8, return_inverse=True)
            total, distinct = np.zeros((len(contexts), len(self.langs))), np.zeros((len(contexts), len(self.langs)))
            np.add.at(total, context, seen)
            np.add.at(distinct, context, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
                direct = -np.log2(seen / (total + distinct)[context])
            below = self.cost[order - 1][np.searchsorted(self.grams[order - 1], grams & ((1 << 8 * order) - 1))] if order else 8.0
            self.cost.append(np.where(seen > 0, direct, escape[context] + below).astype(np.float32))
            self.escape.append(escape.astype(np.float32))
            self.grams.append(grams)
            self.slots.append(self._slots(grams, seen.sum(1)))
            self.contexts.append(contexts)
            self.context_slots.append(self._slots(contexts, total.sum(1)))

    @staticmethod
    def _slot(grams: np.ndarray, shift: int) -> np.ndarray:
        return (grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(shift)

    def _slots(self, grams, weight):
        """One guess per hash slot, the commonest byte string; other ones are found by bisection."""
        shift = 64 - max(8, int(4 * len(grams)).bit_length())
        guess = np.zeros(1 << (64 - shift), np.int32)
        rank = np.argsort(weight, kind="stable")
        guess[self._slot(grams[rank], shift)] = rank
        return shift, guess

    def find(self, table: np.ndarray, slots: tuple[int, np.ndarray], grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a sorted table and whether the byte string is there."""
        if not len(table):
            return np.zeros(len(grams), np.int64), np.zeros(len(grams), bool)
        shift, guess = slots
        at = guess[self._slot(grams, shift)]
        hit = table[at] == grams
        miss = np.flatnonzero(~hit)
        if len(miss):
            rest, where = np.unique(grams[miss], return_inverse=True)
            found = np.minimum(np.searchsorted(table, rest), len(table) - 1)
            at[miss], hit[miss] = found[where], (table[found] == rest)[where]
        return at, hit

    def lengths(self, raw: np.ndarray) -> np.ndarray:
        """Code length in bits of every byte from ORDER on, by language."""
        grams = codes(raw, ORDER)
        at, hit = self.find(self.grams[ORDER], self.slots[ORDER], grams)
        out = self.cost[ORDER][at] if len(self.grams[ORDER]) else np.zeros((len(grams), len(self.langs)), np.float32)
        left = np.flatnonzero(~hit)
        out[left] = 0
        for order in range(ORDER, -1, -1):
            if not len(left):
                return out
            if order < ORDER:
                short = grams[left] & ((1 << 8 * (order + 1)) - 1)
                at, hit = self.find(self.grams[order], self.slots[order], short)
                out[left[hit]] += self.cost[order][at[hit]]
                left = left[~hit]
            # What is left pays the escape of its context, if any language knows it.
            at, hit = self.find(self.contexts[order], self.context_slots[order], (grams[left] & ((1 << 8 * (order + 1)) - 1)) >> 8)
            out[left[hit]] += self.escape[order][at[hit]]
        out[left] += 8
        return out

    def total_bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of whole texts, by language; long ones are summed piece by piece."""
        pieces, owner = [], []
        for i, t in enumerate(texts):
            padded = _PAD + t
            for a in range(0, len(t), _PIECE):
                pieces.append(padded[a:a + _PIECE + ORDER])
                owner.append(i)
        out = np.zeros((len(texts), len(self.langs)))
        at = 0
        while at < len(pieces):
            end, size = at, 0
            while end < len(pieces) and (end == at or size + len(pieces[end]) <= _PIECE):
                size += len(pieces[end])
                end += 1
            bits = self.lengths(np.frombuffer(b"".join(pieces[at:end]), np.uint8))
            starts = np.cumsum([0, *map(len, pieces[at:end - 1])])
            # The ORDER bytes before each later piece are context, not text: their lengths are taken off again.
            ends = starts + [len(p) for p in pieces[at:end]] - ORDER
            sums = np.add.reduceat(bits, np.column_stack([starts, np.minimum(ends, len(bits) - 1)]).ravel(), axis=0, dtype=np.float64)[::2]
            if ends[-1] == len(bits):
                sums[-1] = bits[starts[-1]:].sum(0, dtype=np.float64)
            np.add.at(out, owner[at:end], sums)
            at = end
        return out


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Count the context trees of the sample on the executors and freeze them."""
    rows = training_sample(docs, sample_docs).mapInArrow(_count, "lang string, order int, gram long, n long")
    # As large as the sample at most, which the two parameters above bound.
    return Model(rows.groupBy("lang", "order", "gram").agg(F.sum("n").alias("n")).toPandas())


def _predict(shared, fields):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            known = batch.column("__letter").to_pylist()
            lang, score, per_byte = [UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts)
            rows = [i for i, k in enumerate(known) if k] if model.langs else []
            if rows:
                raw = [texts[i].encode() for i in rows]
                bits = model.total_bits(raw) / np.array([[len(t)] for t in raw])
                share = np.exp2(bits.min(1, keepdims=True) - bits)
                for i, b, s, r in zip(rows, bits.argmin(1), share, bits):
                    lang[i], score[i], per_byte[i] = model.langs[b], float(s.max() / s.sum()), float(r[b])
            yield pa.RecordBatch.from_arrays(
                [batch.column(f) for f in fields] + [batch.column("__held"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(per_byte, pa.float64())],
                [*fields, "held_out", "lang_pred", "score", "bits_per_byte"])
    return run


def predict(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """The given columns of ``docs`` with held_out, lang_pred, score, bits_per_byte.

    ``und`` with score 0 where the text is null or has no letter, and where no
    language was learned.  The score is the winner's share when every language
    weighs 2 ** -(bits per byte).  Ties go to the first language by name.  A
    null id is neither learned from nor held out; repeated rows stay; an empty
    table gives no rows.  Columns of ``docs`` with the added names are replaced.
    """
    spark = docs.sparkSession
    short_batches(spark)
    added = T._parse_datatype_string(_ADDED).fields
    columns = [c for c in columns if c not in {f.name for f in added}]
    rows = docs.select(*columns, F.col("text").alias("__text"), F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("__held"),
                       F.coalesce(F.col("text").rlike(_LETTER), F.lit(False)).alias("__letter"))
    schema = T.StructType([docs.schema[c] for c in columns] + added)
    return rows.mapInArrow(_predict(spark.sparkContext.broadcast(model), columns), schema)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs), ["doc_id"]).select("doc_id", "held_out", "lang_pred", "score")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, with all their columns as they are.

    Those without letters, or that no language codes below 8 bits a byte, go.
    A table from which no language can be learned says nothing about its
    documents: all of them stay.
    """
    model = fit(docs)
    if not model.langs:
        return docs
    # The row travels whole in one column, so that no column of the caller meets one of the operator.
    rows = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    return predict(rows, model, ["__row"]).where((F.col("lang_pred") != UNKNOWN) & (F.col("bits_per_byte") < 8)).select("__row.*")
