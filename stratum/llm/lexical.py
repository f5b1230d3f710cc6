"""Ranked lexical search with per-term geometric blocking.

The documents are dealt out in shards of a bounded number of postings.  In a shard every
term's posting list is clustered by the similarity of its documents (projected vectors of
their weighted terms; evenly spaced documents of the list are the centres).  A block keeps a
summary: for each term the largest contribution to a score of any of its documents.  A query
visits the blocks of its terms from the highest bound (the sum of the summary over the
query's terms; a summary holds what queries can ask of the block) downwards, scores their documents in full, and leaves out a block only if its
bound lies below the score of the tenth document found so far.  Scores are 64-bit integers,
so bounds are exact and no document of the true ranking is ever skipped.

The best of every shard are ranked together.  Queries are answered in blocks of a bounded
number of terms; only such a block of terms is ever sent to the tasks.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from stratum.llm.common import Scratch, split_by_size

# Fixed value of the contract: what separates terms.
_BREAKS = re.compile("[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
QUERY_TERMS = 100_000           # (item, term) pairs answered at once
SHARD_POSTINGS = 250_000
BLOCK = 64                      # documents of a block, about
DIMENSIONS = 16                 # of the projected vectors
ENTRIES = 1_000_000             # postings summarised at once


def terms(text: str) -> list[str]:
    """The terms of a text in order; only A-Z are lower-cased."""
    return [t for t in _BREAKS.split(text.translate(_LOWER)) if t]


def query_terms(items: DataFrame, id: str, text: str) -> DataFrame:
    """item, term: each term of an item once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(set(terms(t.as_py() or ""))) for t in b.column(1)]
            owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(owner, pa.int64())), pa.array([t for f in found for t in f], pa.string())], names=["item", "term"])

    rows = items.select(F.col(id).alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"item {dict(rows.dtypes)['item']}, term string").distinct()


def postings(docs: DataFrame, vocabulary, id: str, text: str) -> DataFrame:
    """id, n (terms with repeats), ids, tfs (the vocabulary's terms of the document) for documents with a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for b in batches:
            row, size, ids, tfs = [], [], [], []
            for k, t in enumerate(b.column(1)):
                found = terms(t.as_py() or "")
                if found:
                    own = {number[w]: c for w, c in Counter(found).items() if w in number}
                    row.append(k)
                    size.append(len(found))
                    ids.append(np.fromiter(own.keys(), np.int32, len(own)))
                    tfs.append(np.fromiter(own.values(), np.int32, len(own)))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(size, pa.int64()),
                                              pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))], names=["id", "n", "ids", "tfs"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, n bigint, ids array<int>, tfs array<int>")


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers starts[i] .. starts[i] + sizes[i] - 1, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def partners(queries: list[np.ndarray]) -> dict[int, np.ndarray]:
    """For each term the terms that some query has beside it, and itself."""
    beside: dict[int, list[np.ndarray]] = {}
    for q in queries:
        for t in q.tolist():
            beside.setdefault(t, []).append(q)
    return {t: np.unique(np.concatenate(qs)) for t, qs in beside.items()}


class Shard:
    """Documents (rows) with their terms' contributions, and the blocks of every posting list.

    A block of term t is only ever asked for terms that queries have beside t: ``beside``.
    """

    def __init__(self, size: np.ndarray, term: np.ndarray, gain: np.ndarray, n_terms: int, beside: dict[int, np.ndarray]):
        self.ends = np.cumsum(size)
        self.size, self.start, self.term, self.gain, self.n_terms = size, self.ends - size, term, gain, n_terms
        doc = np.repeat(np.arange(len(size)), size)
        order = np.argsort(term, kind="stable")
        self.listed, counts = doc[order], np.bincount(term, minlength=n_terms)
        self._cluster(counts)
        self._summarise(beside)

    def _vectors(self) -> np.ndarray:
        """The documents' gains in a few random directions, scaled to length 1."""
        directions = np.random.default_rng(11).standard_normal((self.n_terms, DIMENSIONS)).astype(np.float32)
        out = np.zeros((len(self.size), DIMENSIONS), np.float32)
        full = np.flatnonzero(self.size)
        if len(full):
            weighted = directions[self.term] * self.gain[:, None].astype(np.float32)
            out[full] = np.add.reduceat(weighted, self.start[full])
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def _cluster(self, counts: np.ndarray) -> None:
        """block_term and the documents of each block, block after block."""
        vectors, at = self._vectors(), np.r_[0, np.cumsum(counts)]
        docs, sizes, owner = [], [], []
        for t in np.flatnonzero(counts):
            own = self.listed[at[t]:at[t + 1]]
            centres = -(-len(own) // BLOCK)
            if centres > 1:
                near = vectors[own] @ vectors[own[np.linspace(0, len(own) - 1, centres).astype(int)]].T
                cluster = near.argmax(1)
                order = np.argsort(cluster, kind="stable")
                own, n = own[order], np.bincount(cluster, minlength=centres)
                n = n[n > 0]
            else:
                n = np.array([len(own)])
            docs.append(own)
            sizes.append(n)
            owner.append(np.full(len(n), t))
        none = [np.zeros(0, np.int64)]
        self.block_docs, self.block_size, self.block_term = (np.concatenate(x or none) for x in (docs, sizes, owner))
        self.block_start = np.cumsum(self.block_size) - self.block_size

    def _summarise(self, beside: dict[int, np.ndarray]) -> None:
        """For each term: its blocks and, by block and term beside it, the largest gain of the block's documents."""
        self.blocks, column = {}, np.full(self.n_terms, -1)
        edges = np.flatnonzero(np.r_[True, self.block_term[1:] != self.block_term[:-1], True]) if len(self.block_term) else np.zeros(1, np.int64)
        for first, last in zip(edges[:-1].tolist(), edges[1:].tolist()):
            t = int(self.block_term[first])
            if t not in beside:
                continue
            column[beside[t]] = np.arange(len(beside[t]))
            most = np.zeros((last - first) * len(beside[t]), np.int64)
            block = np.repeat(np.arange(last - first), self.block_size[first:last])
            docs = self.block_docs[self.block_start[first]:self.block_start[first] + len(block)]
            for own in split_by_size(self.size[docs], ENTRIES) if len(docs) > 1 else [slice(0, 1)]:
                place = spans(self.start[docs[own]], self.size[docs[own]])
                at = column[self.term[place]]
                used = at >= 0
                cell = np.repeat(block[own] * len(beside[t]), self.size[docs[own]]) + at
                np.maximum.at(most, cell[used], self.gain[place][used])
            column[beside[t]] = -1
            self.blocks[t] = (first, beside[t], most.reshape(last - first, -1))

    def scores(self, docs: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Whole scores of some documents; ``asked``: 1 at the query's terms."""
        place = spans(self.start[docs], self.size[docs])
        gains = np.r_[0, np.cumsum(self.gain[place] * asked[self.term[place]])]
        ends = np.cumsum(self.size[docs])
        return gains[ends] - gains[ends - self.size[docs]]

    def search(self, query: np.ndarray, ids: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the ``top`` documents of a query (term numbers), ties by ``ids``."""
        asked = np.zeros(self.n_terms, np.int64)
        asked[query] = 1
        visit, bounds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for first, beside, most in (self.blocks[t] for t in query.tolist() if t in self.blocks):
            bounds.append(most[:, np.searchsorted(beside, query)].sum(1))
            visit.append(np.arange(first, first + len(most)))
        visit, bounds = np.concatenate(visit), np.concatenate(bounds)
        order = np.argsort(-bounds, kind="stable")
        visit, bounds = visit[order], bounds[order]
        rows, values, seen, at, step = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(self.size), bool), 0, 4
        while at < len(visit):
            if len(rows) == top and bounds[at] < values[-1]:
                break           # no block from here on can hold a better document
            own = visit[at:at + step]
            if len(rows) == top:
                own = own[bounds[at:at + step] >= values[-1]]
            docs = self.block_docs[spans(self.block_start[own], self.block_size[own])]
            docs = np.unique(docs[~seen[docs]])
            seen[docs] = True
            rows, values = np.r_[rows, docs], np.r_[values, self.scores(docs, asked)]
            best = np.lexsort((ids[rows], -values))[:top]
            rows, values = rows[best], values[best]
            at, step = at + step, min(step * 2, 64)
        return rows[values > 0], values[values > 0]


def _ranked(kept: DataFrame, facts, top: int, id_type: str, item_type: str) -> DataFrame:
    """item, id, score: the best documents of each shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beside = partners([q for _, q in facts.value[0]])
        waiting, n = [], 0
        for b in batches:
            waiting.append(b)
            n += len(b.column("ids").flatten())
            if n >= SHARD_POSTINGS:
                yield from answer(pa.Table.from_batches(waiting), beside)
                waiting, n = [], 0
        if waiting:
            yield from answer(pa.Table.from_batches(waiting), beside)

    def answer(t: pa.Table, beside: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        t = t.combine_chunks()
        items, weights, n_docs, n_all = facts.value
        lists = t.column("ids").combine_chunks()
        size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        term = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        tf = t.column("tfs").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        # a document's length in hundredths of the mean, a tenth of it fixed
        m = 100 - 90 + (90 * t.column("n").to_numpy().astype(np.int64) * n_docs) // n_all
        gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, size)))
        shard = Shard(size, term, gain, len(weights), beside)
        ids = t.column("id").combine_chunks()
        order = np.empty(len(ids), np.int64)
        order[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        owner, rows, scores = [], [], []
        for k, (_, query) in enumerate(items):
            r, s = shard.search(query, order, top)
            owner.append(np.full(len(r), k))
            rows.append(r)
            scores.append(s)
        if rows:
            at = np.concatenate(owner)
            names = pa.array([i for i, _ in items], pa_item)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(at)), ids.take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(scores))], names=["item", "id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string
    pa_item = to_arrow_type(_parse_datatype_string(item_type))
    return kept.mapInArrow(run, f"item {item_type}, id {id_type}, score bigint")


def search(docs: DataFrame, items: DataFrame, *, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", top: int = 10) -> DataFrame:
    """``item_id``, rank, ``id``, score: the ``top`` documents of each item by BM25 in integers, equal scores by ascending id.

    Null and empty texts have no terms and are never found; items without terms, or whose
    terms no document holds, have no rows.  Items that repeat an id are one item with the
    terms of all.  Rows that repeat a document's id are documents of their own; a null id
    comes last among equal scores.  Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexical")
    asked = scratch.keep(query_terms(items, item_id, item_text), "queries")
    parts = -(-asked.count() // QUERY_TERMS)
    out = spark.createDataFrame([], f"item {dict(asked.dtypes)['item']}, id {dict(docs.dtypes)[id]}, score bigint") if not parts else None
    for part in range(parts):
        queries: dict = {}
        for r in asked.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).orderBy("item", "term").toLocalIterator():
            queries.setdefault(r["item"], []).append(r["term"])
        if not queries:
            continue
        number = {t: i for i, t in enumerate(sorted({t for q in queries.values() for t in q}))}
        vocabulary = spark.sparkContext.broadcast(number)
        kept = scratch.keep(postings(docs, vocabulary, id, text), "postings")
        vocabulary.unpersist()
        total = kept.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        df = np.zeros(len(number), np.int64)
        for r in kept.select(F.explode("ids").alias("t")).groupBy("t").count().toLocalIterator():
            df[r["t"]] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
        facts = spark.sparkContext.broadcast(([(i, np.array([number[t] for t in q])) for i, q in queries.items()], weights, total["docs"], max(total["terms"] or 0, 1)))
        found = scratch.keep(_ranked(kept, facts, top, dict(kept.dtypes)["id"], dict(asked.dtypes)["item"]), "found")
        facts.unpersist()
        out = found if out is None else out.union(found)
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select(
        F.col("item").alias(item_id), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id), "score")
