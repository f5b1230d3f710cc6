"""Quality score: a generalised additive model with pairwise interactions.

Figures of the whole text (sizes, shares of character classes, repetition) are cut into
bins.  Boosting goes round the features in turn: each step fits a tree of at most three
leaves to the gradients of one feature and adds it, shrunk, to that feature's lookup table.
Then pairs of features are ranked by how much a cut on each axis reduces what is left, and
the best ones get tables of their own in the same way.  A score is the sum of one entry of
each table: bin numbers and additions, done for a whole batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratum.llm.common import Scratch

FEATURES = ("words", "word_length", "longest_word", "lines", "line_words", "symbols", "bars", "marks", "punctuation", "digits", "capitals",
            "other_bytes", "distinct_words", "repeated_next", "repeated_lines", "top_word")
_CLASSES = {"symbols": b"#*$%&<>@^~=+_\\/{}[]", "bars": b"|", "marks": b"!?", "punctuation": b".,;:'\"()-", "digits": b"0123456789"}
_MASKS = {k: np.isin(np.arange(256), np.frombuffer(v, np.uint8)).astype(np.float64) for k, v in _CLASSES.items()}
_UPPER = ((np.arange(256) >= 65) & (np.arange(256) <= 90)).astype(np.float64)
_LOWER = ((np.arange(256) >= 97) & (np.arange(256) <= 122)).astype(np.float64)


def figures(text: bytes | None) -> list[float]:
    """The features of one text (UTF-8), all 0 for a text without words."""
    text = text or b""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    bytes_ = np.bincount(np.frombuffer(text, np.uint8), minlength=256).astype(np.float64)
    size, n = float(len(text)), len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    upper, lower = bytes_ @ _UPPER, bytes_ @ _LOWER
    shares = [float(bytes_ @ _MASKS[k]) / size for k in _CLASSES]
    longest = max(map(len, seen))
    return [np.log1p(n), sum(map(len, words)) / n, np.log1p(longest), np.log1p(len(lines)), np.log1p(n / len(lines)), *shares,
            float(upper / (upper + lower)) if upper + lower else 0.0, float(bytes_[128:].sum()) / size,
            len(seen) / n ** 0.9, sum(map(eq, words, words[1:])) / n, 1 - len(set(lines)) / len(lines), max(seen.values()) / n]


def measured(docs: DataFrame, id: str, text: str) -> DataFrame:
    """id, figures of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([figures(t.as_py()) for t in b.column(1)], pa.list_(pa.float64()))], names=["id", "figures"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, figures array<double>")


@dataclass
class Additive:
    """Lookup tables of features and pairs; edges of the bins; log-odds where all tables are 0."""
    edges: list[np.ndarray]
    coarse: list[np.ndarray]            # bin -> coarse bin, for the pairs
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]
    level: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], "right") for i, e in enumerate(self.edges)], 1)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.level)
        if len(x) and self.edges:
            b = self.bins(x)
            for i, t in enumerate(self.tables):
                out += t[b[:, i]]
            for (i, j), t in zip(self.pairs, self.pair_tables):
                out += t[self.coarse[i][b[:, i]], self.coarse[j][b[:, j]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -40, 40)))


def _gain(g: np.ndarray, h: np.ndarray, penalty: float) -> np.ndarray:
    return g * g / (h + penalty)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, least: float, penalty: float) -> np.ndarray:
    """Values by bin of a tree over one axis, split greedily where the gain is largest."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = None
        for k, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
            left, right = (cg[:-1], ch[:-1]), (cg[-1] - cg[:-1], ch[-1] - ch[:-1])
            gain = np.where((left[1] >= least) & (right[1] >= least), _gain(*left, penalty) + _gain(*right, penalty) - _gain(cg[-1], ch[-1], penalty), -1.0)
            at = int(gain.argmax())
            if gain[at] > 0 and (best is None or gain[at] > best[0]):
                best = (gain[at], k, a + at + 1)
        if best is None:
            break
        _, k, cut = best
        a, b = parts.pop(k)
        parts += [(a, cut), (cut, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + penalty)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, penalty: float, least: float) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree with one cut on each axis."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    all_g, all_h = cg[-1, -1], ch[-1, -1]
    best, values = 0.0, np.zeros_like(g)
    for i in range(g.shape[0] - 1):
        for j in range(g.shape[1] - 1):
            gs = np.array([cg[i, j], cg[i, -1] - cg[i, j], cg[-1, j] - cg[i, j], all_g - cg[i, -1] - cg[-1, j] + cg[i, j]])
            hs = np.array([ch[i, j], ch[i, -1] - ch[i, j], ch[-1, j] - ch[i, j], all_h - ch[i, -1] - ch[-1, j] + ch[i, j]])
            gain = float(_gain(gs, hs, penalty).sum() - _gain(all_g, all_h, penalty))
            if gain > best:
                v = gs / (hs + penalty)
                best, values = gain, np.zeros_like(g)
                values[:i + 1, :j + 1], values[:i + 1, j + 1:], values[i + 1:, :j + 1], values[i + 1:, j + 1:] = v
    return best, values


def fit(x: np.ndarray, y: np.ndarray, *, bins: int = 32, coarse: int = 8, rounds: int = 120, pair_rounds: int = 40, pairs: int = 6,
        rate: float = 0.1, leaves: int = 3, penalty: float = 2.0, least: float = 1.0) -> Additive:
    """Cyclic boosting of the features' tables, then of the best pairs' tables."""
    share = min(max(y.mean(), 1e-6), 1 - 1e-6) if len(y) else 0.5
    level = float(np.log(share / (1 - share)))
    if len(set(y.tolist())) < 2:
        return Additive([], [], [], [], [], level)
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, bins + 1)[1:-1])) for i in range(x.shape[1])]
    model = Additive(edges, [], [np.zeros(len(e) + 1) for e in edges], [], [], level)
    b = model.bins(x)
    out = np.full(len(x), level)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-out))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for i, t in enumerate(model.tables):
            g, h = slopes()
            step = rate * _tree(np.bincount(b[:, i], g, len(t)), np.bincount(b[:, i], h, len(t)), leaves, least, penalty)
            t += step
            out += step[b[:, i]]
    model.coarse = [np.arange(len(t)) * min(coarse, len(t)) // len(t) for t in model.tables]
    c = np.stack([m[b[:, i]] for i, m in enumerate(model.coarse)], 1)
    shape = [int(m.max()) + 1 for m in model.coarse]

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(c[:, i] * shape[j] + c[:, j], v, shape[i] * shape[j]).reshape(shape[i], shape[j])

    g, h = slopes()
    ranked = sorted(((_quadrants(grid(i, j, g), grid(i, j, h), penalty, least)[0], i, j) for i, j in combinations(range(x.shape[1]), 2)), reverse=True)
    model.pairs = [(i, j) for gain, i, j in ranked[:pairs] if gain > 0]
    model.pair_tables = [np.zeros((shape[i], shape[j])) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for (i, j), t in zip(model.pairs, model.pair_tables):
            g, h = slopes()
            step = rate * _quadrants(grid(i, j, g), grid(i, j, h), penalty, least)[1]
            t += step
            out += step[c[:, i], c[:, j]]
    return model


def classify(docs: DataFrame, labels: DataFrame, learn: Column, *, id: str = "doc_id", text: str = "text", label: str = "quality",
             sample_docs: int = 20000, threshold: float = 0.5, **options) -> DataFrame:
    """``id``, score, predicted, figures for every row.

    Fitted on at most ``sample_docs`` labelled rows, those of the smallest id hashes, among
    label rows where ``learn`` holds; null ids and labels are left out, several labels of one
    id count as their minimum.  Null and empty texts have all figures 0 and the score that
    goes with them.  Without labels of both classes every score is the share of label 1 (a
    half if there are none).  Equal texts get equal scores.  Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    own = scratch.keep(measured(docs, id, text), "figures")
    marked = (labels.where(learn & F.col(label).isNotNull() & F.col(id).isNotNull())
              .groupBy(F.col(id).alias("id")).agg((F.min(label) > 0).cast("int").alias("y")))
    few = marked.orderBy(F.xxhash64("id", F.lit(13)), "id").limit(sample_docs)
    # at most sample_docs ids
    rows = own.join(F.broadcast(few), "id").select("id", "figures", "y").toArrow().to_pandas().sort_values("id")
    x = np.array(rows["figures"].tolist(), np.float64).reshape(len(rows), len(FEATURES))
    held = spark.sparkContext.broadcast(fit(x, rows["y"].to_numpy(np.float64), **options))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for f in batches:
            yield pd.Series(held.value.score(np.array(f.tolist(), np.float64).reshape(len(f), len(FEATURES))))

    scored = own.select("id", "figures", score("figures").alias("score"))
    return scored.select(F.col("id").alias(id), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "figures")
