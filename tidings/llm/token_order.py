"""Training-order materialisation of token sequences.

Documents are encoded, joined by end marks and cut into sequences of a fixed
number of tokens (two bytes each).  Every sequence gets an index, a keyed
Feistel permutation with cycle walking turns the index into its global slot,
and range partitions of the slots write binary shards of fixed stride: the
sequence of slot s lies in shard ``s // per_shard`` at byte
``(s % per_shard) * stride``, so a reader can resume at any slot.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import new_path, short_batches, staged
from .token_cache import model_path

VOCABULARY = "byte_bpe_50k.tiktoken"
#: The first id that the vocabulary leaves free.
END = 50256
TOKENS = 2048
PER_SHARD = 8192
KEY = 20_240_229
ROUNDS = 6


def encoder(vocabulary: str):
    import base64

    import public_tokenizers
    import tiktoken
    with open(model_path(vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _pack(vocabulary: str, tokens: int):
    """Sequences of the task's documents, numbered from 0; the last one is filled up with end marks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, row = encoder(vocabulary), TaskContext.get().partitionId(), 0
        open_, held = [], 0

        def emit(whole: np.ndarray, n: list[int]):
            nonlocal row
            out = pa.RecordBatch.from_arrays(
                [pa.array([part] * len(n), pa.int32()), pa.array(range(row, row + len(n)), pa.int64()), pa.array(n, pa.int32()),
                 pa.array([s.tobytes() for s in whole.reshape(-1, tokens)], pa.binary())], ["part", "row", "n_tokens", "ids"])
            row += len(n)
            return out

        for batch in batches:
            for text in batch.column("text").to_pylist():
                ids = enc.encode_to_numpy(text, disallowed_special=()).astype("<u2")
                open_ += [ids, np.array([END], "<u2")]
                held += len(ids) + 1
                if held >= 64 * tokens:
                    stream = np.concatenate(open_)
                    n = held // tokens
                    yield emit(stream[:n * tokens], [tokens] * n)
                    open_, held = [stream[n * tokens:]], held - n * tokens
        if held:
            stream = np.concatenate(open_)
            n = [tokens] * (held // tokens) + [held % tokens] * (held % tokens > 0)
            yield emit(np.concatenate([stream, np.full(len(n) * tokens - held, END, "<u2")]), n)
    return run


def feistel(index: np.ndarray, size: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """A keyed permutation of 0 .. size - 1; values that leave the range walk on until they are back."""
    half = max(1, -(-max(1, int(size - 1).bit_length()) // 2))
    mask = np.uint64((1 << half) - 1)
    shift = np.uint64(half)

    def mixed(x: np.ndarray, r: int) -> np.ndarray:
        x = x + np.uint64((key * 0x9E3779B97F4A7C15 + (r + 1) * 0xD1B54A32D192ED03) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    out = index.astype(np.uint64)
    walk = np.arange(len(out))
    while len(walk):
        left, right = out[walk] >> shift, out[walk] & mask
        for r in range(rounds):
            left, right = right, left ^ (mixed(right, r) & mask)
        out[walk] = (left << shift) | right
        walk = walk[out[walk] >= np.uint64(size)]
    return out.astype(np.int64)


def sequences(docs: DataFrame, vocabulary: str = VOCABULARY, tokens: int = TOKENS) -> DataFrame:
    """part, row, n_tokens, ids of all sequences, written once so that part and row stay as they are."""
    short_batches(docs.sparkSession)
    texts = docs.select("text").where(F.length("text") > 0)
    return staged(texts.mapInArrow(_pack(vocabulary, tokens), "part int, row long, n_tokens int, ids binary"), "sequences")


def with_slots(rows: DataFrame, key: int = KEY, per_shard: int = PER_SHARD) -> tuple[DataFrame, int]:
    """shard, slot, n_tokens, packed (the ids, compressed for the exchange), and the number of sequences."""
    counts = rows.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One number per task of the writing job.
    starts = staged(counts.select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "sequence_starts")
    size = starts.agg(F.sum("n")).first()[0] or 0

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            slot = feistel(batch.column("index").to_numpy(), size, key)
            yield pa.RecordBatch.from_arrays(
                [pa.array((slot // per_shard).astype(np.int32)), pa.array(slot), batch.column("n_tokens"),
                 pa.array([packer.compress(x) for x in batch.column("ids").to_pylist()], pa.binary())], ["shard", "slot", "n_tokens", "packed"])

    indexed = rows.join(starts.select("part", "start"), "part").select((F.col("start") + F.col("row")).alias("index"), "n_tokens", "ids")
    return indexed.mapInArrow(place, "shard int, slot long, n_tokens int, packed binary"), size


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def _write(path: str, stride: int, per_shard: int):
    """Write each shard of the task, in slot order, under a name of its own, then give it its final name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        import zstandard
        unpack = zstandard.ZstdDecompressor().decompress
        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(base, recursive=True)
        shard, out, name = None, None, None

        def close():
            if out is not None:
                out.close()
                store.move(name, f"{base}/{shard_name(shard)}")

        for batch in batches:
            offsets, sums = [], []
            for s, slot, packed in zip(*(batch.column(c).to_pylist() for c in ("shard", "slot", "packed"))):
                ids = unpack(packed)
                if s != shard:
                    close()
                    shard, name = s, f"{base}/_{uuid.uuid4().hex}"
                    out = store.open_output_stream(name)
                offsets.append(out.tell())
                if offsets[-1] != slot % per_shard * stride or len(ids) != stride:
                    raise ValueError(f"slot {slot} does not follow the one before it")
                out.write(ids)
                sums.append(zlib.crc32(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("slot"), batch.column("shard"), pa.array(offsets, pa.int64()), batch.column("n_tokens"), pa.array(sums, pa.int64())],
                ["slot", "shard", "byte_offset", "n_tokens", "seq_crc32"])
        close()
    return run


def materialise(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, tokens: int = TOKENS,
                per_shard: int = PER_SHARD, key: int = KEY) -> DataFrame:
    """Write the shards of ``docs`` under ``path``; returns slot, shard, byte_offset, n_tokens, seq_crc32 per sequence.

    Null and empty texts give no tokens; every other document gives its ids
    and an end mark.  Repeated rows are written as often as they stand.  The
    last sequence of each task is filled up with end marks (n_tokens counts
    without them).  An empty table writes nothing and returns no rows.  Other
    columns are not read.  A task that runs again writes the same bytes under
    the same final name.
    """
    placed, size = with_slots(sequences(docs, vocabulary, tokens), key, per_shard)
    shards = max(1, -(-size // per_shard))
    ordered = placed.repartitionById(shards, F.col("shard")).sortWithinPartitions("slot")
    return staged(ordered.mapInArrow(_write(path, 2 * tokens, per_shard), "slot long, shard int, byte_offset long, n_tokens int, seq_crc32 long"), "shard_manifest")


def read_sequence(path: str, slot: int, tokens: int = TOKENS, per_shard: int = PER_SHARD) -> np.ndarray:
    """The ids of one slot, read at its fixed place."""
    from pyarrow import fs
    store, base = fs.FileSystem.from_uri(path)
    with store.open_input_file(f"{base}/{shard_name(slot // per_shard)}") as f:
        f.seek(slot % per_shard * 2 * tokens)
        return np.frombuffer(f.read(2 * tokens), "<u2")


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    path = new_path(spark, "token_shards")
    return materialise(docs, path if "://" in path else f"file://{path}")
