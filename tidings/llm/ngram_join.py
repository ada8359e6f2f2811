"""N-gram Jaccard self join by universe partition and pigeonhole.

Sets of shingles of size a and b >= a can only link when they differ in at
most H(a) shingles.  The universe of shingles is hashed into segments, their
number set by the size band.  If tau_i + 1 summed over the segments exceeds
H(a), two linked sets differ by at most tau_i in some segment i; tau_i is -1
(segment skipped), 0 (equal subsets: one signature) or 1 (one-deletion
neighbours: the subset without one of its shingles).  The segments offer more
than H(a) + 1, so each set skips the costly ones: the cost of a signature is
the number of rows that share it.  A segment empty in the smaller set has no
deletions of its own: its equality also meets partners with one shingle there,
so skipping it gives up both.  What is left gives candidate pairs, which are
verified on their whole shingle sets.

Before pairs are formed, the shingles that one candidate set alone holds are
counted.  They stand in its difference to every partner, so a set with more
than H(a) of them has no link, and a pair needs room for those of both.

Only the linked components are asked for, so pairs inside a known component
are not formed: first each set is verified against the leader it shares most
signatures with, then the rest of the candidates across components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import short_batches, staged

WORDS = 4
#: Two sets link when DEN * intersection >= NUM * union.
NUM, DEN = 85, 100
#: Upper end of a size band over its lower end.
BAND = 1.5
#: Segments beyond the needed ones, and segments with one-deletion signatures, each as a share 1 / n.
SPARE, DELETED = 16, 32
#: Bits of the map of wanted documents (a fixed 4 MB); a full map lets more documents through, never fewer.
MAP_BITS = 25
_EMPTY_KEY = 0x5EED
#: 64-bit words of a parity sketch.
SKETCH = 8


def most_differences(a: int, num: int = NUM, den: int = DEN) -> int:
    """Largest symmetric difference of a set of size ``a`` and a larger one that link."""
    b = a * den // num
    return (den - num) * (a + b) // (den + num)


def band_edges(largest: int, num: int = NUM, den: int = DEN) -> list[int]:
    """Lower ends of the size bands; a partner of a band's set lies in that band or the next."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(math.ceil(edges[-1] * BAND), edges[-1] * den // num + 1))
    return edges


def _shape(low: int, high: int, num: int, den: int) -> tuple[int, int]:
    """Segments of a band and how many of them have one-deletion signatures."""
    need = most_differences(high - 1, num, den) + 1
    m = need + need // SPARE + (need > 1)
    return m, max(1, m // DELETED)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct shingles of a whole text as 64-bit hashes, sorted.

    A-Z are lower-cased, words are what is left between the six ASCII blanks.
    """
    from xxhash import xxh64_intdigest
    # bytes.lower() touches A-Z alone, bytes.split() cuts at \x20 and \x09-\x0D alone.
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxh64_intdigest, found), np.uint64, len(found))
    odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)
    width = min(words, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        out = _mix(out + h[i:len(h) - width + 1 + i] * odd[i % len(odd)])
    return np.unique(out)


def set_name(tokens: np.ndarray) -> int:
    """64 bits that name a set (equal sets share it)."""
    both = np.array([tokens.sum(dtype=np.uint64), _mix(tokens).sum(dtype=np.uint64) ^ np.uint64(len(tokens))], np.uint64)
    both = _mix(both)
    return int(_mix(both[:1] * np.uint64(0x9E3779B97F4A7C15) + both[1:]).view(np.int64)[0])


def signatures(tokens: np.ndarray, edges: list[int], num: int = NUM, den: int = DEN):
    """key, unit of the signatures of a set.

    ``unit`` is segment * 16 + roles: 1 index, 2 probe, 4 one-deletion, 8
    equality of an empty segment that has deletions in other sets (it stands
    for both).  A set probes its own band and is indexed there and, if a smaller set's partner
    can be that large, in the band below.
    """
    size = len(tokens)
    band = int(np.searchsorted(edges, size, "right")) - 1
    keys, units = [], []
    for k in (band, band - 1):
        if k < 0:
            continue
        if k < band and size > (edges[k + 1] - 1) * den // num:
            continue
        m, q = _shape(edges[k], edges[k + 1], num, den)
        mixed = _mix(tokens + np.uint64(k + 1))
        segment = (mixed >> np.uint64(32)) % np.uint64(m)
        order = np.argsort(segment, kind="stable")
        segment, mixed = segment[order].astype(np.int64), mixed[order]
        total = np.concatenate([[np.uint64(0)], np.cumsum(mixed, dtype=np.uint64)])
        ends = np.searchsorted(segment, np.arange(m + 1))
        whole = total[ends[1:]] - total[ends[:-1]]
        base = _mix((np.arange(m, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64((k + 1) << 40 | _EMPTY_KEY))
        roles = 3 if k == band else 1
        keys.append(_mix(whole + base))
        empty = (ends[1:] == ends[:-1]) & (np.arange(m) < q)
        units.append(np.arange(m) * 16 + 8 * empty + roles)
        # One-deletion signatures of the first q segments (an empty one has none).
        last = ends[q]
        without = whole[segment[:last]] - mixed[:last]
        keys.append(_mix(without + base[segment[:last]]))
        units.append(segment[:last] * 16 + 4 + roles)
    return np.concatenate(keys).view(np.int64), np.concatenate(units).astype(np.int32)


def parity(tokens: np.ndarray) -> np.ndarray:
    """The parity sketch: bit i tells whether an odd number of shingles falls on place i."""
    place = (_mix(tokens ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(64 * SKETCH)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=64 * SKETCH) & 1).astype(np.uint8)).view(np.int64)


def _sizes(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_name(s) for s in sets], pa.int64())],
                ["doc_id", "n_shingles", "sid"])
    return run


def _keys(words: int, edges: list[int], num: int, den: int):
    """Signature rows of the sets of a task, each set once (its other copies share the name)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            keys, sids, units = [], [], []
            for text in batch.column("text").to_pylist():
                tokens = shingles(text, words)
                sid = set_name(tokens)
                if not len(tokens) or sid in seen:
                    continue
                seen.add(sid)
                k, u = signatures(tokens, edges, num, den)
                keys.append(k), units.append(u), sids.append(np.full(len(k), sid, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, sids, units)], ["key", "sid", "unit"])
    return run


def _map_place(ids: np.ndarray) -> np.ndarray:
    return (_mix(ids.view(np.uint64)) >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _sets(words: int, shared):
    """sid, tokens of the documents that the map of wanted ids does not rule out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = np.frombuffer(shared.value, np.uint8), set()
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            place = _map_place(ids)
            wanted = np.flatnonzero(bits[place >> 3] >> (place & 7).astype(np.uint8) & 1)
            rows = []
            for i, text in zip(wanted, batch.column("text").take(pa.array(wanted)).to_pylist()):
                tokens = shingles(text, words)
                row = int(ids[i]), set_name(tokens)
                if row not in seen:
                    seen.add(row)
                    rows.append((*row, tokens.view(np.int64), parity(tokens)))
            if rows:
                i, sid, tokens, sketch = zip(*rows)
                ends = np.cumsum([0, *map(len, tokens)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i, pa.int64()), pa.array(sid, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(tokens))),
                     pa.array([x.tolist() for x in sketch], pa.list_(pa.int64()))],
                    ["doc_id", "sid", "tokens", "sketch"])
    return run


def wanted_map(ids: DataFrame) -> bytes:
    """A map of 2 ** MAP_BITS bits with the places of ``ids`` (doc_id) set."""
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_map_place(batch.column(0).to_numpy())))], ["place"])

    words = (ids.select("doc_id").mapInArrow(places, "place long")
             .groupBy(F.expr("place >> 15").alias("page"), F.expr("(place >> 3) & 4095").alias("byte")).agg(F.expr("bit_or(1 << (place & 7))").alias("bits"))
             .groupBy("page").agg(F.collect_list("byte").alias("at"), F.collect_list("bits").alias("bits")))
    out = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    # At most 2 ** (MAP_BITS - 15) rows of at most 4096 bytes each.
    for row in words.toLocalIterator():
        out[(row["page"] << 12) + np.array(row["at"])] = np.array(row["bits"], np.uint8)
    return out.tobytes()


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    ends, values = column.offsets.to_numpy(), column.values.to_numpy()
    return (values[a:b] for a, b in zip(ends, ends[1:]))


def _verify(num: int, den: int):
    """The rows whose two sets link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(_lists(batch.column("tx")), _lists(batch.column("ty"))):
                fit = min(len(a), len(b)) * den >= num * max(len(a), len(b))
                both = len(np.intersect1d(a, b, assume_unique=True)) if fit else 0
                keep.append(fit and both > 0 and den * both >= num * (len(a) + len(b) - both))
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))
    return run


def unshared(sets: DataFrame) -> DataFrame:
    """sid, u: how many shingles of a set no other one of ``sets`` holds (no row: none)."""
    held = sets.select("sid", F.explode("tokens").alias("token")).groupBy("token").agg(F.min("sid").alias("sid"), F.max("sid").alias("hi"))
    return held.where("sid = hi").groupBy("sid").agg(F.count("*").alias("u"))


def linked(pairs: DataFrame, sets: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """The pairs (x, y) of set names whose sets link."""
    a = sets.select(F.col("sid").alias("x"), F.col("tokens").alias("tx"))
    b = sets.select(F.col("sid").alias("y"), F.col("tokens").alias("ty"))
    return pairs.join(a, "x").join(b, "y").select("x", "y", "tx", "ty").mapInArrow(_verify(num, den), "x long, y long")


def components(edges: DataFrame) -> DataFrame:
    """sid, comp (smallest name reachable) of all nodes of ``edges`` (x, y).

    Every node takes the smallest label of its neighbours, then the label of
    its label, until nothing changes; each round is written to the shared folder.
    """
    both = staged(edges.select("x", "y").union(edges.select("y", "x")).distinct(), "edges")
    labels = staged(both.groupBy(F.col("x").alias("sid")).agg(F.least(F.min("y"), F.first("x")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("sid").alias("y"), "comp"), "y").groupBy(F.col("x").alias("sid")).agg(F.min("comp").alias("near"))
        hooked = labels.join(near, "sid").select("sid", F.least("comp", "near").alias("new"), F.col("comp").alias("old"))
        up = labels.select(F.col("sid").alias("new"), F.col("comp").alias("top"))
        moved = staged(hooked.join(up, "new").select("sid", F.least("new", "top").alias("comp"), (F.least("new", "top") < F.col("old")).alias("moved")), "labels")
        labels = moved.select("sid", "comp")
        if moved.where("moved").isEmpty():
            return labels


def chosen_probes(live: DataFrame, sizes: DataFrame, edges: list[int], num: int = NUM, den: int = DEN) -> DataFrame:
    """key, sid, deleted: the probe rows left when every set skips its most costly units.

    ``live`` holds key, sid, unit, cost of the signatures that several sets
    share; a unit is a segment's equality or its deletions, whose cost is at
    least that of its equality.  Signatures of no other set cost nothing.  The
    equality of an empty segment with deletions counts as two units skipped.
    """
    offer = F.lit(None).cast("int")
    for low, high in zip(edges, edges[1:]):
        m, q = _shape(low, high, num, den)
        offer = F.when((F.col("n") >= low) & (F.col("n") < high), m + q).otherwise(offer)
    partner = F.floor(F.col("n") * den / num)
    # One unit more than H must stay.
    skip = offer - (F.floor((den - num) * (F.col("n") + partner) / (den + num)) + 1)
    probes = live.where("unit & 2 = 2").select("key", "sid", F.expr("unit >> 4").alias("segment"), F.expr("unit & 4 = 4").alias("deleted"), F.expr("1 + (unit >> 3 & 1)").alias("weight"), "cost")
    units = probes.groupBy("sid", "segment", "deleted").agg(F.sum("cost").alias("cost"), F.max("weight").alias("weight"))
    most = F.max("cost").over(Window.partitionBy("sid", "segment"))
    costly = Window.partitionBy("sid").orderBy(F.desc("rank_cost"), F.desc("deleted"), "segment").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (units.withColumn("rank_cost", F.when(F.col("deleted"), most).otherwise(F.col("cost")))
              .withColumn("r", F.sum("weight").over(costly)).join(sizes.select("sid", "n"), "sid"))
    left = ranked.where(F.col("r") > skip).select("sid", "segment", "deleted")
    return probes.select("key", "sid", "segment", "deleted").join(left, ["sid", "segment", "deleted"]).select("key", "sid", "deleted")


def _pairs(probes: DataFrame, index: DataFrame, comps: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """Distinct candidate pairs (x, y) across components.

    In every key the largest component is left aside from meeting itself, so a
    key that one component fills costs nothing.
    """
    def known(df: DataFrame) -> DataFrame:
        return df.join(comps, "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))

    p, s = staged(known(probes), "probes"), staged(known(index), "index")
    share = s.groupBy("key", "comp").agg(F.count("*").alias("n"))
    main = share.groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.count("*").alias("comps")).where("comps > 1").drop("comps")
    main = staged(main, "main_components")
    def words(side: str) -> list:
        return [F.col(f"w{i}").alias(f"{side}{i}") for i in range(SKETCH)]

    left = p.join(main, "key").select("key", *words("wx"), F.col("sid").alias("x"), F.col("comp").alias("cx"), F.col("deleted").alias("dx"), F.col("n").alias("nx"), F.col("u").alias("ux"), (F.col("comp") == F.col("main")).alias("mx"))
    right = s.join(main, "key").select(F.col("key").alias("k"), *words("wy"), F.col("sid").alias("y"), F.col("comp").alias("cy"), F.col("deleted").alias("dy"), F.col("n").alias("ny"), F.col("u").alias("uy"), (F.col("comp") == F.col("main")).alias("my"))
    differ = sum((F.bit_count(F.col(f"wx{i}").bitwiseXOR(F.col(f"wy{i}"))) for i in range(SKETCH)), F.lit(0))
    fits = ((F.col("cx") != F.col("cy")) & ~(F.col("dx") & F.col("dy")) & (F.col("nx") <= F.col("ny")) & (F.col("ny") * num <= F.col("nx") * den)
            & ((F.col("ux") + F.col("uy")) * (den + num) <= (F.col("nx") + F.col("ny")) * (den - num))
            & (differ * (den + num) <= (F.col("nx") + F.col("ny")) * (den - num)))
    aside = left.where("NOT mx").join(right, (F.col("key") == F.col("k")) & fits)
    inside = left.where("mx").join(right.where("NOT my"), (F.col("key") == F.col("k")) & fits)
    both = aside.select("x", "y").union(inside.select("x", "y"))
    return both.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def ngram_components(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs``.

    Two sets of ``words``-word shingles link when den * intersection >= num * union.
    ``component_id`` is the smallest doc_id reachable by links, itself
    included.  A null or empty text has an empty set and no link.  A row with a
    null id gets its set size and a null component, and links nothing.
    Repeated rows share a component.  An empty table gives no rows; further
    columns are not read.
    """
    spark = docs.sparkSession
    short_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = staged(rows.mapInArrow(_sizes(words), "doc_id long, n_shingles long, sid long"), "shingle_sets")
    known = named.where("doc_id IS NOT NULL AND n_shingles > 0")
    distinct = staged(known.groupBy("sid").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"), F.count("*").alias("copies")), "distinct_sets")
    edges = band_edges(distinct.agg(F.max("n")).first()[0] or 0)
    made = rows.where("doc_id IS NOT NULL").mapInArrow(_keys(words, edges, num, den), "key long, sid long, unit int")
    by_key = Window.partitionBy("key")
    shared = made.withColumn("lo", F.min("sid").over(by_key)).withColumn("hi", F.max("sid").over(by_key)).withColumn("cost", F.count("*").over(by_key))
    # Signatures of one set alone end here; a set seen by several tasks stands once from here on.
    live = staged(shared.where("lo <> hi").select("key", "sid", "unit", "cost").distinct(), "live_signatures")
    probes = staged(chosen_probes(live, distinct, edges, num, den), "chosen_probes")
    # Index rows of the keys that are still probed.
    asked = staged(probes.select("key").distinct(), "probed_keys")
    index = staged(live.where("unit & 1 = 1").join(asked, "key").select("key", "sid", F.expr("unit & 4 = 4").alias("deleted")).distinct(), "index_rows")
    ids = staged(index.select("sid").union(probes.select("sid")).distinct().join(distinct, "sid").select(F.col("first_id").alias("doc_id"), "sid", "n"), "wanted_sets")
    wanted = spark.sparkContext.broadcast(wanted_map(ids))
    tokens = rows.where("doc_id IS NOT NULL").mapInArrow(_sets(words, wanted), "doc_id long, sid long, tokens array<long>, sketch array<long>")
    sets = staged(tokens.join(ids, ["doc_id", "sid"]).select("sid", "tokens", "sketch", "n"), "wanted_tokens")
    room = F.floor((den - num) * (F.col("n") + F.floor(F.col("n") * den / num)) / (den + num))
    able = staged(sets.select("sid", "n", *[F.col("sketch")[i].alias(f"w{i}") for i in range(SKETCH)]).distinct().join(unshared(sets), "sid", "left")
                  .withColumn("u", F.coalesce("u", F.lit(0))).where(F.col("u") <= room), "linkable_sets")
    probes, index = staged(probes.join(able, "sid"), "probes"), staged(index.join(able, "sid"), "index")
    # Each set against the leader (fewest shingles of its own in a key) that it meets in most keys.
    leaders = index.groupBy("key").agg(F.min_by("sid", F.struct("u", "sid")).alias("y"))
    meets = probes.join(leaders, "key").where("sid <> y")
    best = meets.groupBy(F.col("sid").alias("x"), "y").agg(F.count("*").alias("c")).groupBy("x").agg(F.max_by("y", F.struct("c", "y")).alias("y"))
    found = staged(linked(best, sets, num, den), "links_0")
    comps = components(found)
    rest = staged(linked(_pairs(probes, index, comps, num, den), sets, num, den), "links_1")
    comps = components(found.union(rest))
    of_set = distinct.select("sid", "first_id").join(comps, "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    smallest = of_set.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    final = staged(of_set.join(smallest, "comp").select("sid", "component_id"), "set_components")
    joined = named.where("doc_id IS NOT NULL AND n_shingles > 0").join(final, "sid").select("doc_id", "n_shingles", "component_id")
    alone = named.where("doc_id IS NULL OR n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.union(alone)


def keep_one(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id (null ids stay)."""
    dropped = ngram_components(docs, words, num, den).where("doc_id <> component_id").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(dropped, F.col("doc_id") == F.col("__id"), "left_anti")


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return ngram_components(docs)


def brute_force(texts: dict[int, str | None], words: int = WORDS, num: int = NUM, den: int = DEN) -> dict[int, tuple[int, int]]:
    """doc_id to (set size, component) by comparing all pairs of shingle sets."""
    import re
    sets = {}
    for i, t in texts.items():
        found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(found[j:j + words]) for j in range(max(1, len(found) - words + 1))} if found else set()
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * den >= num * max(len(a), len(b)):
                both = len(a & b)
                if den * both >= num * (len(a) + len(b) - both):
                    x, y = sorted((root(i), root(j)))
                    label[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def probe(spark, sf, rows):
    want = brute_force({r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()})
    print("same as brute force", {r[0]: (r[1], r[2]) for r in rows} == want, len(rows), "components", len({w[1] for w in want.values()}))
