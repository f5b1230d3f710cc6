"""Best-fit packing of tokenized documents into sequences: minimum bin slack.

Each task tokenizes its documents, cuts those longer than a sequence, and numbers its pieces
of each length.  The plan needs only the number of pieces of each length, at most as many
rows as a sequence has tokens.  For one bin after another, a bitset subset-sum over the
lengths that are left finds the fullest feasible combination around the longest piece; the
combination is then removed as often as the lengths last, so that the steps grow with the
number of lengths and not with the number of pieces.  The plan (a list of combinations) is
broadcast, and every piece finds its place from its number among the pieces of its length.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from stratum.llm.common import Scratch

END = b"\0\0\0\0"               # id 0 ends a document
CACHE = 300_000                 # words, and parts of words, that a worker remembers
# Latin letters and then ASCII punctuation but the apostrophe: words whose cut is known without the tokenizer's patterns
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]*)([!-&(-/:-@\\[-`{-~]*)")
_WHOLE = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")        # a text with one of these is not cut into words
# byte-level alphabet: a byte that is no printable Latin-1 character stands for the next free code point from 256 on
_BYTES = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class PartIds(dict):
    """Lower-case letters, or punctuation -> ids as little-endian 32-bit numbers."""

    def __init__(self, model):
        super().__init__({"": b""})
        self.model = model

    def __missing__(self, part: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
            self[""] = b""
        known = part if part.isascii() else part.encode().decode("latin-1").translate(_BYTES)
        self[part] = ids = packed([t.id for t in self.model.tokenize(known)])
        return ids


class WordIds(dict):
    """Word without white space -> its ids as little-endian 32-bit numbers."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.parts = PartIds(self.tokenizer.model)
        self.plain = self._is_word_level()

    def _is_word_level(self) -> bool:
        """Whether words can be cut apart: the known lower-casing word tokenizer, else every text goes through whole."""
        sample = "The naïve fox, Über### | x!!"
        return self.whole(sample) == b"".join(map(self.__getitem__, sample.split()))

    def whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        plain = _PLAIN.fullmatch(word)
        self[word] = ids = self.parts[plain[1].lower()] + self.parts[plain[2]] if plain else self.whole(word)
        return ids

    def text(self, text: str) -> bytes:
        if not self.plain or any(w in text for w in _WHOLE):
            return self.whole(text)
        return b"".join(map(self.__getitem__, text.split()))


@lru_cache(2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int, id: str, text: str, with_ids: bool) -> DataFrame:
    """id, piece, start, length, ids_crc32, part, number (and ids): ``number`` counts the task's pieces of that length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = word_ids(tokenizer), TaskContext.get().partitionId()
        numbers = np.zeros(capacity + 1, np.int64)
        for b in batches:
            owner, piece, length, crc, number, ids = [], [], [], [], [], []
            for row, t in enumerate(b.column(1)):
                data = words.text(t.as_py() or "") + END
                for k, s in enumerate(range(0, len(data), 4 * capacity)):
                    own = data[s:s + 4 * capacity]
                    n = len(own) // 4
                    owner.append(row)
                    piece.append(k)
                    length.append(n)
                    crc.append(zlib.crc32(own))
                    number.append(numbers[n])
                    numbers[n] += 1
                    if with_ids:
                        ids.append(np.frombuffer(own, "<i4"))
            out = [b.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(np.array(piece, np.int64) * capacity),
                   pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([part] * len(owner), pa.int32()), pa.array(number, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32", "part", "number"]
            if with_ids:
                out, names = [*out, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = f"id {dict(rows.dtypes)['id']}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, number bigint"
    return rows.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def fullest(left: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, copies) of the combination of the pieces left that fills ``room`` best."""
    lengths = [n for n in sorted(left, reverse=True) if n <= room and left[n]]
    mask, reach, steps = (1 << room + 1) - 1, 1, []
    for n in lengths:
        before, grown = reach, reach
        for _ in range(min(left[n], room // n)):
            more = before | grown << n & mask
            if more == grown:
                break
            grown = more
        steps.append((n, before))
        reach = grown
        if reach >> room & 1:
            break
    total, out = reach.bit_length() - 1, []
    for n, before in reversed(steps):
        copies = 0
        while not before >> total & 1:
            total -= n
            copies += 1
        if copies:
            out.append((n, copies))
    return out


def plan(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations (length -> copies) and how many sequences have them; all pieces are used up."""
    left, out = {n: c for n, c in counts.items() if c}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        use = dict(fullest(left, capacity - longest))
        left[longest] += 1
        use[longest] = use.get(longest, 0) + 1
        times = min(left[n] // k for n, k in use.items())
        for n, k in use.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
        out.append((use, times))
    return out


class Places:
    """For each length, the numbers that each combination takes and where it puts them."""

    def __init__(self, combinations: list[tuple[dict[int, int], int]]):
        taken, rows, first = {}, {}, 0
        for use, times in combinations:
            offset = 0
            for n in sorted(use, reverse=True):
                start = taken.get(n, 0)
                rows.setdefault(n, []).append((start, first, use[n], offset))
                taken[n] = start + times * use[n]
                offset += n * use[n]
            first += times
        self.rows = {n: np.array(r, np.int64) for n, r in rows.items()}

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece."""
        sequence, offset = np.empty_like(length), np.empty_like(length)
        for n in np.unique(length):
            at = np.flatnonzero(length == n)
            own = self.rows[int(n)]
            start, first, copies, base = own[np.searchsorted(own[:, 0], number[at], "right") - 1].T
            sequence[at] = first + (number[at] - start) // copies
            offset[at] = base + (number[at] - start) % copies * n
        return sequence, offset


def pack(docs: DataFrame, tokenizer: str, *, id: str = "doc_id", text: str = "text", capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """Per piece: ``id``, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Every row is a document, also one that repeats an id; null and empty texts are the single
    id 0.  Documents over ``capacity`` tokens are cut into full pieces and a rest.  Pieces of
    a sequence lie without gaps from offset 0.  An empty table has no pieces.  Other columns
    are not read.  ``with_ids`` adds the piece's ids; ``sequences`` puts them together.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    own = scratch.keep(pieces(docs, tokenizer, capacity, id, text, with_ids), "pieces")
    by_part = own.groupBy("length", "part").agg(F.count("*").alias("n"))
    # one row for each length
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.sparkContext.broadcast(Places(plan(counts, capacity)))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    numbered = own.join(by_part.select("length", "part", F.coalesce(before, F.lit(0)).alias("before")), ["length", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = places.value.find(b.column("length").to_numpy(), b.column("number").to_numpy())
            names = [n for n in b.schema.names if n != "number"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    kept = ["id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    types = dict(numbered.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in kept) + ", sequence_id bigint, offset bigint"
    return (numbered.select(*kept, (F.col("number") + F.col("before")).alias("number"))
            .mapInArrow(run, schema).withColumnRenamed("id", id))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the token sequences, from pieces packed ``with_ids``; a group has at most a sequence's tokens."""
    return packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("pieces")).select(
        "sequence_id", F.flatten(F.transform("pieces", lambda p: p["ids"])).alias("ids"))
