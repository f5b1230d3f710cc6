"""SimHash near-duplicates with Golay-code fuzzy hashing.

Fingerprints of 64 bits are cut into three segments, each read as a word of the perfect
binary Golay code (23, 12).  A segment's keys are indices of nearby codewords: the nearest
one (at most three bits away) and, for words of odd weight, the five at four bits' distance,
where there are any.  Two segments that differ in at most one bit share a key: if they
differ, one of them is even and its nearest codeword is among the keys of the other.

With four differing bits at most, either two segments differ in at most one bit each, or one
segment is equal and the others differ in two bits each (which leaves their parities equal).
So the keys of a fingerprint are the pairs of codeword indices for each two segments, and
each segment's bits with the others' parities: about 33.  Fingerprints that share a key are
compared bit by bit, in blocks of at most ``BLOCK`` per task and group; groups above that
are dealt out as pairs of blocks, with no limit on their size.  Of the links found in a group
only a spanning forest leaves the task; connected components over those give the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from stratum.llm.common import Scratch
from stratum.llm.components import components

SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))    # first bit and length
GENERATOR = 0xC75                           # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
MOST_BITS = 4                               # what the keys guarantee
BLOCK = 4096
PIECE = 200_000                             # shingles counted at once
FEW_LARGE = 50_000                          # keys of large groups that are sent to all tasks


def fingerprint(text: bytes | None, shingle: int) -> int:
    """64-bit SimHash of the ``shingle``-word sequences of a text, repeats included; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.r_[0, ends[:-1]].tolist()
    ends = ends.tolist()
    n = max(len(words) - shingle + 1, 1)
    width = min(shingle, len(words)) - 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for s in range(0, n, PIECE):
        t = min(s + PIECE, n)
        h = np.fromiter([digest(joined[a:z - 1], SEED) for a, z in zip(starts[s:t], ends[s + width:t + width])], np.uint64, t - s)
        ones += np.unpackbits(h.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, id: str, text: str, shingle: int) -> DataFrame:
    """id, fp for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["id", "fp"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, fp bigint")


@lru_cache(1)
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By syndrome: the nearest codeword's error pattern, and five patterns of weight four (0: none); syndromes of bytes."""
    def syndrome(v: int) -> int:
        for bit in range(22, 10, -1):
            if v >> bit & 1:
                v ^= GENERATOR << (bit - 11)
        return v

    bits = [syndrome(1 << i) for i in range(23)]
    leaders, fours, found = np.zeros(2048, np.int64), np.zeros((2048, 5), np.int64), np.zeros(2048, np.int64)
    for weight in range(1, 5):
        for places in combinations(range(23), weight):
            s, v = 0, 0
            for p in places:
                s, v = s ^ bits[p], v | 1 << p
            if weight < 4:
                leaders[s] = v
            else:
                fours[s, found[s]] = v
                found[s] += 1
    by_byte = np.array([[syndrome(b << 8 * k) if b << 8 * k < 1 << 23 else 0 for b in range(256)] for k in range(3)], np.int64)
    return leaders, fours, by_byte


def segment_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices of each 23-bit word, shape (n, 6), and which of them count."""
    leaders, fours, by_byte = golay()
    s = by_byte[0][words & 255] ^ by_byte[1][words >> 8 & 255] ^ by_byte[2][words >> 16]
    errors = np.c_[leaders[s], fours[s]]
    used = errors != 0
    used[:, 1:] &= (np.bitwise_count(words.astype(np.uint64)) & 1).astype(bool)[:, None]
    used[:, 0] = True
    return (words[:, None] ^ errors) >> 11, used


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of the fingerprints and the index of the fingerprint each belongs to."""
    v = fps.view(np.uint64)
    parts = [((v >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    parity = [(np.bitwise_count(p.astype(np.uint64)) & 1).astype(np.int64) for p in parts]
    near = [segment_keys(p) for p in parts]
    out, owner, everyone = [], [], np.arange(len(v))
    for kind, (i, j) in enumerate(combinations(range(3), 2)):
        (a, ua), (b, ub) = near[i], near[j]
        k = (kind << 32 | a[:, :, None] << 12 | b[:, None, :]).reshape(len(v), -1)
        used = (ua[:, :, None] & ub[:, None, :]).reshape(len(v), -1)
        out.append(k[used])
        owner.append(np.repeat(everyone, used.sum(1)))
    for i in range(3):
        j, k = [x for x in range(3) if x != i]
        out.append((3 + i) << 32 | parts[i] << 2 | parity[j] << 1 | parity[k])
        owner.append(everyone)
    return np.concatenate(out), np.concatenate(owner)


def _key_rows(fps: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                fp = b.column(0).to_numpy(zero_copy_only=False)
                k, owner = keys(fp)
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(fp[owner])], names=["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key bigint, fp bigint")


def _forest(group: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of the rows of each group (rows sorted by group), reduced to a star for each connected part."""
    n = len(fp)
    label = np.arange(n)
    step, rows = 1, np.flatnonzero(group[1:] == group[:-1])
    while len(rows):
        close = rows[np.bitwise_count(fp[rows] ^ fp[rows + step]) <= max_bits]
        other = close + step
        while len(close):
            low = np.minimum(label[close], label[other])
            apart = label[close] != label[other]
            if not apart.any():
                break
            np.minimum.at(label, label[close[apart]], low[apart])
            np.minimum.at(label, label[other[apart]], low[apart])
            while (label[label] != label).any():
                label = label[label]
            close, other = close[apart], other[apart]
        step += 1
        rows = rows[rows + step < n]
        rows = rows[group[rows] == group[rows + step]]
    linked = np.flatnonzero(label != np.arange(n))
    return linked, label[linked]


def _links(rows: DataFrame, group: list[str], max_bits: int) -> DataFrame:
    """a, b: spanning links of each group; a group must fit a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            if not len(cols[-1]):
                continue
            kept = cols if kept is None else [np.concatenate(x) for x in zip(kept, cols)]
            changed = np.flatnonzero(np.any([c[1:] != c[:-1] for c in kept[:-1]], 0))
            if not len(changed) or len(kept[-1]) < 4 * BLOCK:
                continue
            cut = changed[-1] + 1
            yield from found([c[:cut] for c in kept])
            kept = [c[cut:] for c in kept]
        if kept is not None:
            yield from found(kept)

    def found(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        number = np.cumsum(np.r_[0, np.any([c[1:] != c[:-1] for c in cols[:-1]], 0)])
        fp = cols[-1]
        a, b = _forest(number, fp.view(np.uint64), max_bits)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])

    return (rows.select(*group, "fp").repartition(*group).sortWithinPartitions(*group)
            .mapInArrow(run, "a bigint, b bigint").distinct())


def linked_fingerprints(fps: DataFrame, max_bits: int, scratch: Scratch | None = None) -> DataFrame:
    """a, b: links whose connected parts are those of all pairs at ``max_bits`` or fewer differing bits.

    Spark takes the key rows for about as small as the fingerprints they are made from, and might
    send them all to the driver; so the keys of large groups are written, and the join is chosen by their number.
    """
    scratch = scratch or Scratch(fps.sparkSession, "links")
    rows = _key_rows(fps)
    large = scratch.keep(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK), "large-groups")
    n = large.count()
    if not n:
        return _links(rows, ["key"], max_bits)
    large = large.hint("broadcast" if n <= FEW_LARGE else "merge")
    small = rows.join(large, "key", "left_anti")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = (rows.join(large, "key").select("key", "fp", blocks.alias("blocks"), F.pmod(F.xxhash64("fp", F.lit(3)), blocks).cast("int").alias("own"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"))
    return _links(small, ["key"], max_bits).union(_links(dealt, ["key", "i", "j"], max_bits))


def near_duplicates(docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``id``, fingerprint (16 hex digits), component_id (smallest id reachable by links) for every row.

    Null and empty texts have fingerprint 0 and are linked like any other.  Rows that repeat
    an id each get a row; equal fingerprints are always linked.  A null id gets the smallest
    other id of its class, or null if there is none.  Other columns are not read.
    """
    if max_bits > MOST_BITS:
        raise ValueError(f"the keys find pairs of at most {MOST_BITS} differing bits")
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    own = scratch.keep(fingerprints(docs, id, text, shingle), "fingerprints")
    fps = scratch.keep(own.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    roots = components(linked_fingerprints(fps, max_bits, scratch), scratch)
    rooted = (fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "component_id")
    return own.join(classes, "fp").select(
        F.col("id").alias(id), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
