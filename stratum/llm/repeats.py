"""Removal of passages that an earlier document holds too, with run-length indexes.

Every string of ``match`` bytes contains one smallest hash of its 16-byte strings, its anchor;
equal strings have equal anchors.  Only anchors that several rows hold can lie in a repeat.
Neighbouring strings with one such anchor form a segment, equal segments of all documents
become one with the smallest id (its owner), and the segments of an anchor meet in one task.

There the segments are put after each other and a run-compressed Burrows-Wheeler transform of
them is built.  At the head of each run a sample keeps the text position, and how far its
suffix matches the suffix before it.  Along the text a match shrinks by one byte a step until
the next sample, so the samples give the matching statistics of every position as a stream.
Suffixes that match by ``match`` bytes or more form classes, and the smallest owner of each
class says which strings of a segment an earlier document holds.  Anchors with more than
``MOST_SEGMENTS`` segments are grouped string by string instead, with sums before the shuffle.

A document's bytes are removed where a string of its own is held by an earlier document: in all
of a segment that it does not own, and in the strings found above where it does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from stratum.llm.common import Scratch

ANCHOR = 16                     # bytes of an anchor
PIECE = 1 << 18                 # strings looked at once
CUT = 64                        # strings of a segment
INDEXED = 1 << 17               # bytes of segments indexed at once; its arrays stay in the cache
MOST_SEGMENTS = 8192            # of an anchor in an index
_MIX = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9], np.uint64)


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers starts[i] .. starts[i] + sizes[i] - 1, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _anchors(body: np.ndarray, first: int, n: int, match: int) -> np.ndarray:
    """The smallest hash in each of the ``n`` strings of ``match`` bytes from byte ``first`` on."""
    width = match - ANCHOR + 1
    words = np.ndarray(n + width - 1 + 8, "<u8", body, first, (1,))
    h = words[:-8] * _MIX[0]
    other = words[8:] * _MIX[1]
    other >>= np.uint64(7)
    h ^= other
    np.right_shift(h, np.uint64(31), other)
    h ^= other
    h *= _MIX[2]
    np.right_shift(h, np.uint64(29), other)
    h ^= other
    step = 1
    while 2 * step <= width:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    return np.minimum(h[:n], h[width - step:width - step + n])


class Texts:
    """The bytes of a column of texts after each other: text ``i`` is ``body[at[i]:at[i + 1]]``."""

    def __init__(self, column: pa.Array):
        column = column.fill_null(b"")
        _, ends, data = column.buffers()
        self.at = np.frombuffer(ends, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
        self.body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)

    def segments(self, match: int) -> tuple[np.ndarray, ...]:
        """text, start, number of strings and 48-bit key of each run of strings with one anchor."""
        whole = int(self.at[-1]) - match + 1
        places, anchors, last = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], None
        for first in range(int(self.at[0]), whole, PIECE):
            n = min(PIECE, whole - first)
            low = _anchors(self.body, first, n, match)
            # a run goes on over the end of a piece: where segments start depends on their text alone
            head = np.r_[last is None or low[0] != last, low[1:] != low[:-1]]
            head[self.at[(self.at >= first) & (self.at < first + n)] - first] = True
            heads, last = np.flatnonzero(head), low[-1]
            places.append(heads + first)
            anchors.append(low[heads])
        heads, low = np.concatenate(places), np.concatenate(anchors)
        text = np.searchsorted(self.at, heads, "right") - 1
        size = np.minimum(np.r_[heads[1:], max(whole, 0)][:len(heads)], self.at[text + 1] - match + 1) - heads
        full = size > 0             # else the strings reach into the next text
        heads, text, size = heads[full], text[full], size[full]
        parts = -(-size // CUT)
        at = spans(np.zeros(len(heads), np.int64), parts) * CUT
        key = low[full] * _MIX[0]
        key = ((key ^ key >> np.uint64(32)) & np.uint64((1 << 48) - 1)).astype(np.int64)
        return np.repeat(text, parts), np.repeat(heads, parts) + at, np.minimum(np.repeat(size, parts) - at, CUT), np.repeat(key, parts)

    def shared(self, keys: pa.Array, match: int) -> tuple[np.ndarray, ...]:
        """The segments whose anchors are among their text's ``keys``."""
        text, start, count, key = self.segments(match)
        size = keys.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        listed = keys.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        held = np.isin(text << 48 | key, np.repeat(np.arange(len(keys)), size) << 48 | listed)
        return text[held], start[held], count[held], key[held]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of fewer rows than a number of 15 bits counts."""
    for b in batches:
        for at in range(0, b.num_rows, 32768):
            yield b.slice(at, 32768)


def _rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("text"))


def _keys_of(rows: DataFrame, match: int) -> DataFrame:
    """id, key: each anchor of each row, once a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            text, _, _, key = Texts(b.column(1)).segments(match)
            both = np.unique(text << 48 | key)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(both >> 48)), pa.array(both & (1 << 48) - 1)], names=["id", "key"])

    return rows.where("id IS NOT NULL").mapInArrow(run, f"id {dict(rows.dtypes)['id']}, key bigint")


def shared_keys(rows: DataFrame, match: int, scratch: Scratch) -> DataFrame:
    """id, keys: the anchors of each row that another row holds too."""
    keys = _keys_of(rows, match)
    several = scratch.keep(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "several")
    scratch.release()
    out = scratch.keep(keys.join(several, "key", "left_semi").groupBy("id").agg(F.collect_list("key").alias("keys")), "keys")
    scratch.release()
    return out


def owned_segments(rows: DataFrame, keys: DataFrame, match: int, scratch: Scratch) -> DataFrame:
    """key, segment, owner: each different segment with a shared anchor, and the smallest id that holds it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            texts = Texts(b.column("text"))
            text, start, count, key = texts.shared(b.column("keys"), match)
            for at in range(0, len(start), PIECE // CUT):
                own = slice(at, at + PIECE // CUT)
                size = count[own] + match - 1
                body = texts.body[spans(start[own], size)]
                ends = pa.py_buffer(np.r_[0, np.cumsum(size)].astype(np.int32))
                found = pa.Array.from_buffers(pa.binary(), len(size), [None, ends, pa.py_buffer(body)])
                yield pa.RecordBatch.from_arrays([pa.array(key[own]), found, b.column("id").take(pa.array(text[own]))], names=["key", "segment", "id"])

    joined = rows.join(keys.hint("shuffle_hash"), "id").select("id", "text", "keys")
    # written by itself, so that the shuffled texts are gone before the segments are shuffled
    found = scratch.keep(joined.mapInArrow(run, f"key bigint, segment binary, id {dict(rows.dtypes)['id']}"), "found", compression="zstd")
    scratch.release()
    owned = scratch.keep(found.groupBy("key", "segment").agg(F.min("id").alias("owner")), "segments", compression="zstd")
    scratch.drop(found)
    scratch.release()
    return owned


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of texts, with samples at the heads of its runs.

    ``body``: the texts' bytes after each other, ``size``: their lengths.  Each text ends with
    a symbol of its own, so suffixes compare within their texts only.
    """

    def __init__(self, body: np.ndarray, size: np.ndarray):
        n = len(body) + len(size)
        ends = np.cumsum(size + 1) - 1
        symbols = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends] = False
        symbols[inside] = body.astype(np.int64) + 1
        self.symbols, self.rounds = symbols, []
        order, rank = self._sort(symbols)
        before = symbols[order - 1]
        heads = np.flatnonzero(np.r_[True, before[1:] != before[:-1]] | (before == 0))
        self.order = order
        self.run_symbol, self.run_size = before[heads], np.diff(np.r_[heads, n])
        place, above = order[heads], order[heads - 1]
        length = self._common(place, above)
        length[heads == 0] = 0
        by_place = np.argsort(place)
        self.sample, self.sample_match = place[by_place], length[by_place]

    def _sort(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order and the rank of each; the ranks by the first 7, 14, 28 ... symbols stay in ``rounds``."""
        n, width = len(symbols), 7
        one = np.r_[symbols, np.zeros(width, np.int64)]
        two = one[:-1] << 9 | one[1:]
        three, four = two[:-1] << 9 | one[2:], two[:-2] << 18 | two[2:]
        key = four[:n] << 27 | three[4:4 + n]
        ends = np.flatnonzero(symbols == 0)
        # suffixes that end within the key: nothing of the next text counts, and none is like any other
        before = np.diff(np.r_[-1, ends])
        left = spans(np.zeros(len(ends), np.int64), np.minimum(before, width))
        ended = np.repeat(ends, np.minimum(before, width)) - left
        key[ended] &= -1 << 9 * (width - left)
        order = np.argsort(key)
        alive = np.ones(n, bool)
        alive[ended] = False
        last = np.flatnonzero(~alive[order])
        ended = np.sort(ended)
        order[last] = ended[np.argsort(key[ended], kind="stable")]     # equal ones in the order of the texts
        ordered = key[order]
        fresh = np.r_[True, ordered[1:] != ordered[:-1]] | ~alive[order]
        while True:
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(fresh) - 1
            self.rounds.append((width, rank))
            tied = np.flatnonzero(~(fresh & np.r_[fresh[1:], True]))
            if not len(tied):
                return order, rank
            own = order[tied]               # ended ones are never tied, so the text goes on for ``width`` symbols
            key = rank[own] << 32 | rank[own + width]
            by_key = np.argsort(key)
            order[tied], key = own[by_key], key[by_key]
            fresh[tied] = np.r_[True, key[1:] != key[:-1]]
            width *= 2

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``a`` and ``b``."""
        out = np.zeros(len(a), np.int64)
        last = len(self.symbols) - 1
        for width, rank in reversed(self.rounds):
            out += width * (rank[np.minimum(a + out, last)] == rank[np.minimum(b + out, last)])
        for _ in range(6):
            x, y = self.symbols[np.minimum(a + out, last)], self.symbols[np.minimum(b + out, last)]
            out += (x == y) & (x != 0)
        return out

    def matches(self) -> np.ndarray:
        """For each text position, how many symbols its suffix has in common with the suffix before it."""
        run = np.diff(np.r_[self.sample, len(self.symbols)])
        return np.repeat(self.sample_match + self.sample, run) - np.arange(len(self.symbols))

    def least(self, value: np.ndarray, match: int) -> np.ndarray:
        """For each text position the smallest ``value`` of the positions that share its next ``match`` symbols."""
        first = np.flatnonzero(self.matches()[self.order] < match)
        low = np.minimum.reduceat(value[self.order], first)
        out = np.empty_like(value)
        out[self.order] = np.repeat(low, np.diff(np.r_[first, len(value)]))
        return out


def held_earlier(body: np.ndarray, size: np.ndarray, owner: np.ndarray, match: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment and offset of the strings that a segment of a smaller owner holds too."""
    index = RunLengthIndex(body, size)
    texts = np.repeat(np.arange(len(size)), size + 1)
    low = index.least(owner[texts], match)
    offset = spans(np.zeros(len(size), np.int64), size + 1)
    found = np.flatnonzero((low < owner[texts]) & (offset <= size[texts] - match))
    return texts[found], offset[found]


def _indexed(owned: DataFrame, match: int, id_type: str) -> DataFrame:
    """id, segment_hash, offsets: what the owner of each segment loses of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for b in batches:
            t = pa.Table.from_batches([b])
            kept = t if kept is None else pa.concat_tables([kept, t])
            key = kept.column("key").to_numpy()
            changed = np.flatnonzero(key[1:] != key[:-1]) + 1
            if len(changed) and kept.nbytes > 2 * INDEXED:
                yield from answer(kept.slice(0, changed[-1]))
                kept = kept.slice(changed[-1])
        if kept is not None and kept.num_rows:
            yield from answer(kept)

    def answer(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key = t.column("key").to_numpy()
        size = pc.binary_length(t.column("segment")).to_numpy().astype(np.int64)
        heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        ends = np.r_[heads[1:], len(key)]
        alone = np.repeat(ends - heads == 1, ends - heads)
        if alone.any():                 # nothing to compare them with: the owner keeps all of them
            own = t.filter(pa.array(alone))
            nothing = pa.ListArray.from_arrays(pa.array(np.zeros(own.num_rows + 1, np.int32)), pa.array([], pa.int32()))
            yield from pa.table({"id": own.column("owner"), "segment_hash": own.column("segment_hash"), "offsets": nothing}).to_batches()
            t, key, size = t.filter(pa.array(~alone)), key[~alone], size[~alone]
            if not len(key):
                return
            heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            ends = np.r_[heads[1:], len(key)]
        start = 0
        while start < len(heads):       # whole anchors, about INDEXED bytes at once
            total = np.cumsum(np.add.reduceat(size, heads[start:]))
            stop = start + max(1, int(np.searchsorted(total, INDEXED, "right")))
            yield from index(t.slice(heads[start], ends[stop - 1] - heads[start]))
            start = stop

    def index(t: pa.Table) -> Iterator[pa.RecordBatch]:
        t = t.combine_chunks()
        owner = pc.rank(t.column("owner"), tiebreaker="dense").to_numpy().astype(np.int64)
        own = t.column("segment").combine_chunks()
        size = pc.binary_length(own).to_numpy(zero_copy_only=False).astype(np.int64)
        _, at, data = own.buffers()
        first = np.frombuffer(at, np.int32)[own.offset]
        body = np.frombuffer(data, np.uint8)[first:first + size.sum()]
        text, offset = held_earlier(body, size, owner, match)
        number = np.bincount(text, minlength=len(size))
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(number)].astype(np.int32)), pa.array(offset.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([t.column("owner").combine_chunks(), t.column("segment_hash").combine_chunks(), lists], names=["id", "segment_hash", "offsets"])

    rows = owned.select("key", "segment", "owner", F.xxhash64("segment").alias("segment_hash")).repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(run, f"id {id_type}, segment_hash bigint, offsets array<int>")


def _by_string(owned: DataFrame, match: int) -> DataFrame:
    """The same as ``_indexed`` for anchors with very many segments: string by string."""
    strings = owned.select("owner", "segment", F.xxhash64("segment").alias("segment_hash")).withColumn(
        "offset", F.explode(F.sequence(F.lit(0), F.octet_length("segment") - match)))
    strings = strings.select("owner", "segment_hash", "offset", F.substring(F.col("segment"), F.col("offset") + 1, F.lit(match)).alias("string"))
    first = strings.groupBy("string").agg(F.min("owner").alias("least"))
    lost = strings.join(first, "string").select(F.col("owner").alias("id"), "segment_hash", F.when(F.col("least") < F.col("owner"), F.col("offset")).alias("offset"))
    return lost.groupBy("id", "segment_hash").agg(F.collect_list("offset").alias("offsets"))


def removal(texts: Texts, keys: pa.Array, owned: pa.Array, match: int) -> np.ndarray:
    """Which bytes go: those of strings in segments of other owners, and of the strings listed in ``owned`` (hash, offsets)."""
    text, start, count, _ = texts.shared(keys, match)
    view, hashed = memoryview(texts.body), xxhash.xxh64_intdigest
    own = np.array([hashed(view[a:z], 42) for a, z in zip(start.tolist(), (start + count + match - 1).tolist())], np.uint64).view(np.int64)
    listed = owned.flatten()
    owner = np.repeat(np.arange(len(owned)), owned.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    code = listed.field("segment_hash").to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.lexsort((code, owner))
    both = np.empty(len(order), [("t", np.int64), ("h", np.int64)])
    both["t"], both["h"] = owner[order], code[order]
    asked = np.empty(len(own), both.dtype)
    asked["t"], asked["h"] = text, own
    _, number = np.unique(np.concatenate([both, asked]), return_inverse=True)
    place = np.full(number.max(initial=-1) + 1, -1)
    place[number[:len(both)]] = order
    place = place[number[len(both):]]       # of each segment in ``listed``, or -1
    alien = place < 0
    edge = np.zeros(len(texts.body) + 1, np.int32)
    np.add.at(edge, start[alien], 1)
    np.add.at(edge, (start + count + match - 1)[alien], -1)
    offsets = listed.field("offsets")
    size = offsets.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.cumsum(size) - size
    lost = np.repeat(start[~alien], size[place[~alien]]) + offsets.flatten().to_numpy(zero_copy_only=False)[spans(first[place[~alien]], size[place[~alien]])]
    np.add.at(edge, lost, 1)
    np.add.at(edge, lost + match, -1)
    return np.cumsum(edge[:-1]) > 0


def _cut(rows: DataFrame, facts: DataFrame, match: int, id_type: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            texts = Texts(b.column("text"))
            gone = removal(texts, b.column("keys"), b.column("owned"), match)
            starts, ends = texts.at[:-1], texts.at[1:]
            head = gone.copy()
            head[1:] &= ~gone[:-1]
            full = starts[starts < ends]
            head[full] = gone[full]
            removed, runs = (np.r_[0, np.cumsum(x)] for x in (gone, head))
            removed, runs = removed[ends] - removed[starts], runs[ends] - runs[starts]
            digest = [hashlib.sha256(texts.body[a:z][~gone[a:z]] if n else texts.body[a:z]).hexdigest() for a, z, n in zip(starts.tolist(), ends.tolist(), removed.tolist())]
            yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(x, pa.int64()) for x in (ends - starts, removed, runs)), pa.array(digest, pa.string())],
                                             names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = rows.join(facts.hint("shuffle_hash"), "id", "left").select("id", "text", "keys", "owned")
    return joined.mapInArrow(run, f"id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def cut_repeats(docs: DataFrame, *, id: str = "doc_id", text: str = "text", match: int = 50) -> DataFrame:
    """``id``, n_bytes, n_removed, n_spans, kept_sha256 for every row.

    A byte goes if a string of ``match`` bytes that covers it also starts in a row with a
    smaller id.  Null texts are empty; texts shorter than ``match`` lose nothing.  Rows that
    repeat an id do not remove each other's text, and rows with a null id neither lose text
    nor remove any.  Texts of any length are read in pieces.  Other columns are not read.
    """
    if match < 2 * ANCHOR:
        raise ValueError(f"matches have at least {2 * ANCHOR} bytes")
    scratch = Scratch(docs.sparkSession, "repeats")
    rows, id_type = _rows(docs, id, text), dict(docs.dtypes)[id]
    keys = shared_keys(rows, match, scratch)
    owned = owned_segments(rows, keys, match, scratch)
    many = scratch.keep(owned.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > MOST_SEGMENTS).select("key"), "many")
    lost = scratch.keep(_indexed(owned.join(many, "key", "left_anti"), match, id_type).unionByName(_by_string(owned.join(many, "key", "left_semi"), match)), "lost")
    scratch.release()
    of_owner = lost.groupBy("id").agg(F.collect_list(F.struct("segment_hash", "offsets")).alias("owned"))
    facts = scratch.keep(keys.join(of_owner, "id", "left"), "facts")
    scratch.release()
    return _cut(rows, facts, match, id_type).withColumnRenamed("id", id)
