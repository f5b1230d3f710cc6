"""Language identification with interpolated Kneser-Ney character models.

One 4-gram character model per language.  Counting: every task counts the packed
4-grams of its documents per language; one shuffle adds them up over the whole corpus, by
the exact n-gram.  The model grows with the distinct n-grams of each language; it is built
on the driver and broadcast.  Lower orders use continuation counts (distinct left
extensions), each order its own absolute discount.

Scoring: sorted hash arrays, one per order, hold for each n-gram seen in any language its
interpolated log-probability under *every* language, so that a position costs one binary
search; unseen n-grams go through the context's back-off weights to the next lower order.
The language with the lowest cross-entropy per character wins.  Rejection is calibrated by
cross-validation: every document that the model learns from is scored in tasks by a model
without the counts of its fold, and from all these scores mean and spread of the right language's
cross-entropy are fitted as functions of the text's length; a text whose cross-entropy lies ``reject_z`` spreads,
and ``reject_margin`` nats, above the mean is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from stratum.llm.common import Scratch, small_batches, split_by_size

ORDER = 4
BITS = 12                               # of a character's id; 0 is "no letter"
PIECE = 250_000                       # characters handled at once
FOLDS = 4                               # of the cross-validation
SLOPES = np.geomspace(0.02, 1, 12)      # of the confidence, to choose from
MEDIAN = 10_000                         # accuracy: ranks are right to one in so many
UNDETERMINED = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)    # odd, so that multiplying is one-to-one

_ids: np.ndarray | None = None


def character_ids() -> np.ndarray:
    """Code point -> id: letters below 3072 keep their number, others share 1023 classes; 0 for the rest."""
    global _ids
    if _ids is None:
        points = np.arange(0x110000)
        out = np.where(points < 3072, points, 3072 + points % 1023).astype(np.int64)
        out[[not chr(i).isalpha() for i in range(0x110000)]] = 0
        _ids = out
    return _ids


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed 4-grams of all texts and the index of the text each belongs to.

    Lower case; every run of characters that are no letters is one boundary, and a text
    starts and ends with one.  Texts with no letter have no n-grams.
    """
    lowered = [t.lower() for t in texts]
    lengths = np.fromiter((len(t) + 1 for t in lowered), np.int64, len(lowered))
    points = np.frombuffer((" ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    ids = character_ids()[points]
    letter = ids != 0
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    owner = np.repeat(np.arange(len(lowered)), lengths)[kept]
    last = ids[kept]
    if not len(last):
        return last, owner
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    code = last.copy()
    for back in range(1, ORDER):
        before = np.zeros_like(last)
        before[back:] = last[:-back]
        for i in range(back):           # nothing stands before a text's first character
            at = starts + i
            before[at[at < len(last)]] = np.where(owner[at[at < len(last)]] == owner[starts[at < len(last)]], 0, before[at[at < len(last)]])
        code |= before << (BITS * back)
    return code, owner


def pieces(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Texts cut into pieces of at most ``PIECE`` characters, and the text each comes from."""
    out, owner = [], []
    for i, t in enumerate(texts):
        for s in range(0, max(len(t), 1), PIECE):
            out.append(t[s:s + PIECE])
            owner.append(i)
    return out, np.array(owner, np.int64)


def _add_up(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    codes, counts = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[first], np.add.reduceat(counts, first)


def count_ngrams(docs: DataFrame, text: str, lang: str, fold: Column) -> DataFrame:
    """lang, code, n, n_0, n_1 ...: counts over all rows with text and language; n_k leaves out the rows of fold k."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[tuple[str, int], list] = {}
        for batch in batches:
            frame = batch.to_pandas()
            for key, part in frame.groupby(["lang", "fold"], sort=False):
                texts, _ = pieces(part["text"].tolist())
                held = got.setdefault(key, [[], [], 0])
                for s in split_by_size(np.array([len(t) for t in texts]), PIECE):
                    codes = ngrams(texts[s])[0]
                    if len(codes):
                        codes, n = np.unique(codes, return_counts=True)
                        held[0].append(codes)
                        held[1].append(n)
                        held[2] += len(codes)
                    if held[2] > 4 * PIECE:
                        codes, n = _add_up(held[0], held[1])
                        held[:] = [[codes], [n], len(codes) // 2]
        for (name, fold_), (codes, n, _) in got.items():
            if codes:
                codes, n = _add_up(codes, n)
                n = n.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(codes)), pa.array(codes), pa.array(n), *(pa.array(n * (fold_ != k)) for k in range(FOLDS))],
                    names=["lang", "code", "n", *without])

    without = [f"n_{k}" for k in range(FOLDS)]
    return (_labelled(docs, text, lang, fold).mapInArrow(count, "lang string, code bigint, n bigint" + "".join(f", {c} bigint" for c in without))
            .groupBy("lang", "code").agg(*[F.sum(c).alias(c) for c in ("n", *without)]))


def _labelled(docs: DataFrame, text: str, lang: str, fold: Column) -> DataFrame:
    return docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), fold.cast("int").alias("fold"))


@dataclass
class Table:
    """Sorted hashes and a row of values for each, one column per language."""
    keys: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, codes: np.ndarray, values: np.ndarray) -> "Table":
        keys = codes.astype(np.uint64) * _MIX
        order = np.argsort(keys)
        return cls(keys[order], values[order].astype(np.float32))

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = codes.astype(np.uint64) * _MIX
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return at, self.keys[at] == keys


class _Order:
    """Counts of one order in one language: sorted codes, probabilities' parts, contexts."""

    def __init__(self, codes: np.ndarray, n: np.ndarray):
        self.codes, self.n = codes, n.astype(np.float64)
        once, twice = (n == 1).sum(), (n == 2).sum()
        self.discount = min(max(once / (once + 2 * twice), 0.1), 0.9) if once else 0.5
        context = codes >> BITS
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
        self.contexts = context[first]
        self.totals = np.add.reduceat(self.n, first)
        self.backoff = self.discount * np.diff(np.r_[first, len(codes)]) / self.totals


def _orders(codes: np.ndarray, n: np.ndarray) -> list[_Order]:
    """Orders 1 to 4; below the highest, an n-gram counts its distinct left extensions."""
    out = [_Order(codes, n)]
    for order in range(ORDER - 1, 0, -1):
        codes, n = np.unique(out[-1].codes & ((1 << BITS * order) - 1), return_counts=True)
        out.append(_Order(codes, n))
    return out[::-1]


def _find(sorted_codes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_codes, codes), len(sorted_codes) - 1)
    return at, sorted_codes[at] == codes


def _prob(orders: list[_Order], codes: np.ndarray, order: int) -> np.ndarray:
    """Interpolated Kneser-Ney probability of each n-gram's last character after its context."""
    if not order:
        return np.full(len(codes), 1 / (1 << BITS))
    o = orders[order - 1]
    lower = _prob(orders, codes & ((1 << BITS * (order - 1)) - 1), order - 1)
    at, seen = _find(o.contexts, codes >> BITS)
    there, has = _find(o.codes, codes)
    own = np.where(has, np.maximum(o.n[there] - o.discount, 0), 0) / o.totals[at]
    return np.where(seen, own + o.backoff[at] * lower, lower)


class Model:
    """Kneser-Ney models of all languages in shared sorted hash arrays."""

    def __init__(self, counts: pa.Table, column: str):
        counts = counts.filter(pc.field(column) > 0)
        self.langs = sorted(pc.unique(counts["lang"]).to_pylist())
        orders = []
        for lang in self.langs:
            own = counts.filter(pc.field("lang") == lang)
            codes, n = own["code"].to_numpy(), own[column].to_numpy()
            order = np.argsort(codes)
            orders.append(_orders(codes[order], n[order]))
        self.grams, self.contexts = [], []
        for k in range(1, ORDER + 1):
            codes = np.unique(np.concatenate([o[k - 1].codes for o in orders])) if orders else np.zeros(0, np.int64)
            self.grams.append(Table.of(codes, np.log(np.stack([_prob(o, codes, k) for o in orders], 1)) if orders else np.zeros((0, 0))))
            seen = np.unique(np.concatenate([o[k - 1].contexts for o in orders])) if orders else codes
            rows = []
            for o in orders:
                at, has = _find(o[k - 1].contexts, seen)
                rows.append(np.where(has, np.log(o[k - 1].backoff[at]), 0))
            self.contexts.append(Table.of(seen, np.stack(rows, 1) if rows else np.zeros((0, 0))))

    def log_probs(self, codes: np.ndarray, order: int = ORDER) -> np.ndarray:
        if not order:
            return np.full((len(codes), len(self.langs)), -np.log(1 << BITS), np.float32)
        grams, contexts = self.grams[order - 1], self.contexts[order - 1]
        at, seen = grams.find(codes)
        out = grams.values[at]
        missing = np.flatnonzero(~seen)
        if len(missing):
            rest = codes[missing]
            lower = self.log_probs(rest & ((1 << BITS * (order - 1)) - 1), order - 1)
            at, has = contexts.find(rest >> BITS)
            out[missing] = lower + np.where(has[:, None], contexts.values[at], 0)
        return out

    def cross_entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Characters of each text (0: no letter) and nats per character under each language."""
        parts, owner = pieces(texts)
        total, chars = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        for s in split_by_size(np.array([len(t) for t in parts]), PIECE):
            codes, own = ngrams(parts[s])
            if len(codes):
                first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                at = owner[s][own[first]]
                np.add.at(total, at, np.add.reduceat(self.log_probs(codes), first, dtype=np.float64))
                np.add.at(chars, at, np.diff(np.r_[first, len(codes)]))
        return chars, -total / np.maximum(chars, 1)[:, None]


@dataclass
class Identifier:
    """A model with its calibration: per language mean, variance floor and variance per 1/length."""
    model: Model
    mean: np.ndarray
    spread: np.ndarray
    per_char: np.ndarray
    slope: float
    reject_z: float
    reject_margin: float

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        n, langs = len(texts), self.model.langs
        out = pd.DataFrame({"lang_pred": [UNDETERMINED] * n, "score": np.zeros(n), "cross_entropy": np.full(n, np.nan), "rejected": np.ones(n, bool)})
        if not langs or not n:
            return out
        chars, h = self.model.cross_entropies([t or "" for t in texts])
        known = np.flatnonzero(chars > 0)
        best = h.argmin(1)
        low = h[np.arange(n), best]
        gap = -(h - low[:, None]) * np.minimum(chars, 200)[:, None] * self.slope
        out.loc[known, "lang_pred"] = np.array(langs, object)[best[known]]
        out.loc[known, "score"] = (1 / np.exp(gap).sum(1))[known]
        out.loc[known, "cross_entropy"] = low[known]
        above = self.reject_z * np.sqrt(self.spread[best] + self.per_char[best] / np.maximum(chars, 1))
        limit = self.mean[best] + np.maximum(above, self.reject_margin)
        out.loc[known, "rejected"] = (low > limit)[known]
        return out


def fold_scores(docs: DataFrame, models: list[Model], text: str, lang: str, fold: Column) -> DataFrame:
    """lang, chars, own, losses: each labelled row under the model without its fold.

    ``own`` is the right language's cross-entropy, ``losses`` the log loss of each slope in
    ``SLOPES``.  Rows whose language that model does not know are left out.
    """
    held = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, part in batch.to_pandas().groupby("fold", sort=False):
                model = held.value[k]
                part = part[part["lang"].isin(model.langs)]
                if not len(part):
                    continue
                chars, h = model.cross_entropies(part["text"].tolist())
                right = np.searchsorted(model.langs, part["lang"].to_numpy(object))
                each = np.arange(len(h))
                gaps = -(h - h.min(1)[:, None]) * np.minimum(chars, 200)[:, None]
                losses = []
                for t in SLOPES:
                    p = np.exp(gaps * t)
                    losses.append(-np.log(np.maximum(p[each, right] / p.sum(1), 1e-12)))
                losses = pa.ListArray.from_arrays(pa.array(np.arange(len(h) + 1, dtype=np.int32) * len(SLOPES)), pa.array(np.stack(losses, 1).ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(part["lang"].tolist(), pa.string()), pa.array(chars), pa.array(h[each, right]), losses],
                                                 names=["lang", "chars", "own", "losses"])

    return _labelled(docs, text, lang, fold).mapInArrow(run, "lang string, chars double, own double, losses array<double>")


def calibrated(final: Model, scores: DataFrame, reject_z: float, reject_margin: float, least: int = 20) -> Identifier:
    """Mean and spread of the right language's cross-entropy; slope of the confidence.

    ``scores`` (see :func:`fold_scores`) is read whole; a row of figures for each language
    comes to the driver.  A language with fewer than ``least`` usable rows takes the figures
    of all.  With none at all nothing is rejected but texts without a letter.  Medians, so
    that a few rows with a wrong label change nothing; 0.455 is the median of a squared
    normal deviate.
    """
    size = len(final.langs)
    mean, spread, per_char, slope = np.full(size, np.inf), np.zeros(size), np.zeros(size), 0.05
    at = {lang: [i] for i, lang in enumerate(final.langs)} | {None: range(size)}
    usable = scores.where("chars >= 20")
    median = lambda c: F.percentile_approx(c, 0.5, MEDIAN)
    # the row without a language is that of all
    middles = usable.rollup("lang").agg(F.count("*").alias("n"), median("own").alias("middle"), median("chars").alias("length")).where(F.col("n") >= least)
    middles = middles.toArrow().to_pylist()
    if middles:
        schema = "lang string, n bigint, middle double, length double"
        small = scores.sparkSession.createDataFrame([(r["lang"], r["n"], r["middle"], r["length"]) for r in middles], schema)
        y = (F.col("own") - F.col("middle")) ** 2 / 0.455
        figures = (usable.withColumnRenamed("lang", "label").join(F.broadcast(small), F.col("lang").isNull() | (F.col("lang") == F.col("label")))
                   .groupBy("lang", "middle").agg(median(F.when(F.col("chars") >= F.col("length"), y)).alias("spread"), median(y * F.col("chars")).alias("per_char")))
        for r in sorted(figures.collect(), key=lambda r: r["lang"] is not None):     # the figures of all first
            for i in at[r["lang"]]:
                mean[i], spread[i], per_char[i] = r["middle"], max(r["spread"], 0.01 ** 2), max(r["per_char"], 0.25)
    losses = scores.where("chars > 0").agg(*[F.avg(F.col("losses")[i]) for i in range(len(SLOPES))]).first()
    if losses[0] is not None:
        slope = float(SLOPES[int(np.argmin(losses))])
    return Identifier(final, mean, spread, per_char, slope, reject_z, reject_margin)


def calibration_sample(rows: DataFrame, docs: int, per_language: int) -> pd.DataFrame:
    """For a look at single rows; no figure of the model comes from it (see :func:`calibrated`).

    lang, text, overall: the ``docs`` rows of the smallest draw of all, and the ``per_language`` smallest of each language.

    ``rows`` has draw (a hash), lang and text.  A threshold on the hash, from each language's
    number of draws, leaves few rows before they are ranked.  Repeated rows, which have equal
    draws, take one place of their language's, and a row in both samples counts once.
    """
    first = rows.orderBy("draw").limit(docs).toArrow().to_pandas()
    size = rows.groupBy("lang").agg(F.approx_count_distinct("draw", 0.02).alias("size"))
    enough = 1.2 * (per_language + 6 * per_language ** 0.5 + 20)
    # the draw as a number from 0 to 1 against the share of the language that is needed
    near = rows.join(F.broadcast(size), "lang").where(F.col("draw") / 2.0 ** 64 + 0.5 <= enough / F.col("size"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    near = near.select("draw", "lang", "text").dropDuplicates(["draw", "lang"])
    each = near.withColumn("rank", rank).where(F.col("rank") <= per_language).drop("rank").toArrow().to_pandas()
    both = pd.concat([first.assign(overall=True), each.assign(overall=False)], ignore_index=True)
    again = both.duplicated(["draw", "lang"]) & ~both["overall"]
    return both[~again].sort_values(["overall", "draw", "lang"], ignore_index=True)


def train(docs: DataFrame, learn: Column, *, id: str = "doc_id", text: str = "text", lang: str = "lang",
          reject_z: float = 8.0, reject_margin: float = 0.6) -> Identifier:
    """Fit on all rows where ``learn`` holds, with text and language.

    Rows are dealt to ``FOLDS`` folds by id hash.  Slope, means and spreads come from the scores
    of all rows, each under a model of the other folds; the final model has the counts of all.
    An empty table gives a model without languages, which answers ``und`` and rejects.
    """
    small_batches(docs.sparkSession)
    fold = F.pmod(F.xxhash64(F.coalesce(F.col(id).cast("string"), F.lit("")), F.lit(7)), F.lit(FOLDS))
    rows = docs.where(learn)
    # one row for each distinct n-gram of a language
    counts = count_ngrams(rows, text, lang, fold).toArrow()
    scores = fold_scores(rows, [Model(counts, f"n_{k}") for k in range(FOLDS)], text, lang, fold)
    final = Model(counts, "n")
    del counts                  # the driver holds one model while the rows are scored
    return calibrated(final, Scratch(docs.sparkSession, "langid").keep(scores, "scores"), reject_z, reject_margin)


def predictor(docs: DataFrame, identifier: Identifier):
    """Column function text -> struct(lang_pred, score, cross_entropy, rejected)."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(identifier)

    @F.pandas_udf("lang_pred string, score double, cross_entropy double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield held.value.predict(texts.tolist())

    return predict


def identify(docs: DataFrame, identifier: Identifier, *, text: str = "text", into: str = "prediction") -> DataFrame:
    """All rows with a struct column ``into``: lang_pred, score, cross_entropy, rejected.

    Null texts and texts without a letter: ``und``, score 0, rejected.  Equal texts get equal
    answers; a tie between languages goes to the first by name.  An existing column ``into``
    is replaced; all other columns stay as they are.
    """
    return docs.withColumn(into, predictor(docs, identifier)(F.col(text)))
