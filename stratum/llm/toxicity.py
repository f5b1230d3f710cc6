"""Toxic spans with a linear-chain conditional random field.

Words (maximal runs without white space) carry the tag toxic or clean.  Labels exist per
document only, so the field is fitted to words labelled from them: in toxic documents a word
counts as toxic if it, or one of its prefixes, occurs in at least ``marker_share`` of the
sampled toxic documents and ``marker_lift`` times as often there as in clean ones; every
other word is clean.  The field has features of a word (itself, its prefixes) and the four
transitions; it is fitted by gradient ascent on the exact likelihood.

Forward-backward marginals give each word's probability of being toxic.  A document's score
is a logistic function of their sum over different words (as a ratio to and an excess over
what a clean text of the length has by chance), its share of the words, and the highest; runs of words with a marginal of a half or more are the offending
spans.  The recursion runs over windows of ``WINDOW`` words; when texts are scored the windows
overlap, and each word's marginal comes from the window in which it has at least ``MARGIN``
words of context on either side (or the text's end), so it does not depend on its place.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratum.llm.common import small_batches, split_by_size

WINDOW = 128
MARGIN = 16                     # words on each side that only lend their context
EVIDENCE = 5                    # figures of a document
CHUNK = 1_000_000               # characters scored at once
CACHE = 200_000                 # word scores a worker remembers
_PART = re.compile(r"\w+")
_WORD = re.compile(r"\S+")


def _features(word: str) -> list[str]:
    """The word itself and its prefixes of 4 to 7 characters."""
    return [f"={word}", *(word[:k] for k in range(4, min(7, len(word)) + 1))]


def _parts(raw: str) -> list[str]:
    return _PART.findall(raw.lower())


class WordScores(dict):
    """Raw word -> log-odds of the tag toxic: the highest of its alphanumeric parts."""

    def __init__(self, weights: dict[str, float], bias: float):
        super().__init__()
        self.weights, self.bias = weights, bias

    def __missing__(self, raw: str) -> float:
        get = self.weights.get
        score = self.bias + max((sum(get(f, 0.0) for f in _features(p)) for p in _parts(raw)), default=0.0)
        if len(self) >= CACHE:
            self.clear()
        self[raw] = score
        return score


def overlapping(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of ``WINDOW`` words that overlap by twice ``MARGIN``, so that every word has its neighbours in one of them.

    Returns the words (their numbers) of the windows one after the other, the windows'
    lengths, and for each word where it stands there, furthest from an edge.
    """
    stride = WINDOW - 2 * MARGIN
    per = np.where(lengths > 0, np.maximum(-(-(lengths - 2 * MARGIN) // stride), 1), 0)
    owner = np.repeat(np.arange(len(lengths)), per)
    first_window, first_word = np.cumsum(per) - per, np.cumsum(lengths) - lengths
    start = (np.arange(len(owner)) - first_window[owner]) * stride
    size = np.minimum(lengths[owner] - start, WINDOW)
    at = np.cumsum(size) - size
    words = np.arange(size.sum()) + np.repeat(first_word[owner] + start - at, size)
    text = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(lengths.sum()) - first_word[text]
    window = first_window[text] + np.clip((place - MARGIN) // stride, 0, per[text] - 1)
    return words, size, at[window] + place - start[window]


@dataclass
class Chain:
    """Words of several texts laid out as windows: row = place in the window, column = window."""
    row: np.ndarray
    column: np.ndarray
    windows: int
    inside: np.ndarray

    @classmethod
    def of(cls, lengths: np.ndarray) -> "Chain":
        per = -(-lengths // WINDOW)
        place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        column = np.repeat(np.cumsum(per) - per, lengths) + place // WINDOW
        row = place % WINDOW
        inside = np.zeros((WINDOW, int(per.sum())), bool)
        inside[row, column] = True
        return cls(row, column, int(per.sum()), inside)

    def marginals(self, scores: np.ndarray, transitions: np.ndarray, counts: bool = False):
        """Probability of toxic for each word; with ``counts`` also the expected transitions and the log-partition."""
        a = np.exp(transitions)
        e = np.ones((WINDOW, self.windows))
        e[self.row, self.column] = np.exp(np.clip(scores, -30, 30))
        forward = np.empty((WINDOW, self.windows))
        one = np.full(self.windows, 0.5)
        log_z = np.zeros(self.windows)
        for t in range(WINDOW):
            if t:
                u1, u0 = (one * a[1, 1] + (1 - one) * a[0, 1]) * e[t], one * a[1, 0] + (1 - one) * a[0, 0]
            else:
                u1, u0 = 0.5 * e[t], np.full(self.windows, 0.5)
            z = u0 + u1
            one = u1 / z
            forward[t] = one
            if counts:
                log_z += np.where(self.inside[t], np.log(z), 0)
        expected = np.zeros((2, 2))
        out = np.empty((WINDOW, self.windows))
        back = np.full(self.windows, 0.5)           # share of the state toxic in the backward message
        for t in range(WINDOW - 1, -1, -1):
            f = forward[t]
            up, down = f * back, (1 - f) * (1 - back)
            out[t] = up / (up + down)
            if not t:
                break
            if counts:
                g = forward[t - 1]
                pair = np.stack([(1 - g) * a[0, 0] * (1 - back), (1 - g) * a[0, 1] * e[t] * back, g * a[1, 0] * (1 - back), g * a[1, 1] * e[t] * back])
                expected += ((pair / pair.sum(0)) * self.inside[t]).sum(1).reshape(2, 2)
            v1, v0 = a[1, 1] * e[t] * back + a[1, 0] * (1 - back), a[0, 1] * e[t] * back + a[0, 0] * (1 - back)
            back = np.where(self.inside[t], v1 / (v1 + v0), 0.5)
        marginals = out[self.row, self.column]
        return (marginals, expected, float(log_z.sum())) if counts else marginals


def _doc_features(words: list[str], marginals: np.ndarray, rate: float) -> np.ndarray:
    """Evidence of one document over its different words: sum against what a clean text of the length has, excess, the same ratio over all words, share, highest log-odds."""
    if not len(marginals):
        return np.zeros(EVIDENCE)
    hot = np.flatnonzero(marginals > 0.05)
    best: dict[str, float] = {}
    for i in hot:
        word = words[i].lower()
        best[word] = max(best.get(word, 0.0), float(marginals[i]))
    total, chance, top = sum(best.values()), rate * len(marginals), max(best.values(), default=0.0)
    every = float(marginals[hot].sum())
    return np.array([max(np.log((total + 0.5) / (chance + 0.5)), 0.0), np.log1p(max(total - chance, 0.0)), max(np.log((every + 0.5) / (chance + 0.5)), 0.0),
                     min(100 * total / len(marginals), 10) / 10,
                     min(max(np.log(max(top, 1e-9) / max(1 - top, 1e-9)), 0.0), 10.0) / 5])


@dataclass
class Tagger:
    weights: dict[str, float]
    bias: float
    transitions: np.ndarray
    rate: float                     # toxic words expected in a word of clean text
    coefficients: np.ndarray        # of the document's evidence; the last is the intercept

    def scorer(self) -> WordScores:
        return WordScores(self.weights, self.bias)

    def evidence(self, texts: list[str], scores: WordScores) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        """Words, marginals and evidence of each text."""
        words = [t.split() for t in texts]
        lengths = np.array([len(w) for w in words], np.int64)
        flat = np.fromiter(map(scores.__getitem__, chain.from_iterable(words)), np.float64, int(lengths.sum()))
        marginals = flat
        if len(flat):
            own, size, place = overlapping(lengths)
            marginals = Chain.of(size).marginals(flat[own], self.transitions)[place]
        ends = np.cumsum(lengths)
        for own, n, end in zip(words, lengths, ends):
            m = marginals[end - n:end]
            yield own, m, _doc_features(own, m, self.rate)

    def predict(self, texts: list[str | None], scores: WordScores, threshold: float) -> pd.DataFrame:
        evidence, spans, tokens = [], [], []
        texts = [t or "" for t in texts]
        for s in split_by_size(np.array([len(t) for t in texts]), CHUNK):
            for text, (_, m, x) in zip(texts[s], self.evidence(texts[s], scores)):
                evidence.append(x)
                tokens.append(float(m.sum()))
                spans.append(_spans(text, m) if len(m) and m.max() >= 0.5 else [])
        x = np.array(evidence).reshape(len(texts), EVIDENCE)
        score = 1 / (1 + np.exp(-np.clip(x @ self.coefficients[:-1] + self.coefficients[-1], -40, 40)))
        return pd.DataFrame({"score": score, "predicted": (score >= threshold).astype(np.int32), "toxic_words": tokens, "spans": spans})


def _spans(text: str, marginals: np.ndarray) -> list[dict]:
    """Code-point offsets (start, end) of runs of words with a marginal of a half or more."""
    out, open_ = [], False
    for hit, m in zip(_WORD.finditer(text), marginals):
        if m >= 0.5 and open_:
            out[-1]["end"] = hit.end()
        elif m >= 0.5:
            out.append({"start": hit.start(), "end": hit.end()})
        open_ = m >= 0.5
    return out


def _labelled(docs: list[list[list[str]]], toxic: np.ndarray, share: float, lift: float) -> list[np.ndarray]:
    """Word labels from document labels; ``docs`` holds the parts of each raw word.

    A feature counts once for each different word before it, so that copies of one text
    don't make their words look like markers.
    """
    n0, n1 = max(int((toxic == 0).sum()), 1), max(int((toxic == 1).sum()), 1)

    def before(of: int, only: set[str]) -> dict[str, set[str]]:
        seen = defaultdict(set)
        for parts, label in zip(docs, toxic):
            if label == of:
                done, last = set(), ""
                for p in chain.from_iterable(parts):
                    if p not in done:
                        done.add(p)
                        for f in _features(p):
                            if f in only:
                                seen[f].add(last)
                    last = p
        return seen

    least = max(4, share * n1)
    docs_with = Counter(f for parts, label in zip(docs, toxic) if label for f in {f for p in set(chain.from_iterable(parts)) for f in _features(p)})
    common = {f for f, k in docs_with.items() if k >= least}
    del docs_with
    often = {f: len(k) for f, k in before(1, common).items() if len(k) >= least}
    clean = before(0, set(often))
    marks = {f for f, k in often.items() if k / n1 >= lift * (len(clean.get(f, ())) + 0.5) / n0}
    marked: dict[str, bool] = {}

    def is_marked(p: str) -> bool:
        if p not in marked:
            marked[p] = any(f in marks for f in _features(p))
        return marked[p]

    return [np.array([bool(label) and any(map(is_marked, raw)) for raw in parts], bool) for parts, label in zip(docs, toxic)]


def fit(texts: list[str], toxic: np.ndarray, prior: float, *, marker_share: float = 0.02, marker_lift: float = 15.0,
        rounds: int = 60, l2: float = 1e-4) -> Tagger:
    """Fit field and document score; ``prior`` is the share of toxic rows among all labelled ones."""
    transitions = np.zeros((2, 2))
    words = [t.split() for t in texts]
    if not len(texts) or len(set(toxic.tolist())) < 2:
        level = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)) if len(texts) else -20.0
        return Tagger({}, -20.0, transitions, 0.0, np.r_[np.zeros(EVIDENCE), level])
    types: dict[str, int] = {}
    index = [np.array([types.setdefault(w, len(types)) for w in own], np.int64) for own in words]
    parts = [_parts(w) for w in types]
    labels = _labelled([[parts[i] for i in own] for own in index], toxic, marker_share, marker_lift)
    lengths = np.array([len(w) for w in words], np.int64)
    token, label = np.concatenate(index), np.concatenate(labels).astype(np.float64)
    # while fitting, a raw word has the features of all its parts; most have one; features that occur once in all texts are left out
    # (a marker occurs in four documents at least); occurrences are counted by hash, so that only the names of features kept are held
    hashes = np.fromiter((zlib.crc32(f.encode("utf-8", "surrogatepass")) for ps in parts for p in ps for f in _features(p)), np.uint32)
    each = np.fromiter((sum(4 if len(p) > 6 else max(len(p) - 3, 0) for p in ps) + len(ps) for ps in parts), np.int64, len(parts))
    values, place = np.unique(hashes, return_inverse=True)
    twice = np.bincount(place, np.repeat(np.bincount(token, minlength=len(parts)), each), len(values))[place] > 1
    names: dict[str, int] = {}
    for f, kept in zip((f for ps in parts for p in ps for f in _features(p)), twice):
        if kept:
            names.setdefault(f, len(names))
    del hashes, each, values, place, twice
    features = [np.array(sorted({names[f] for p in ps for f in _features(p) if f in names}), np.int32) for ps in parts]
    flat_features, owner = np.concatenate(features), np.repeat(np.arange(len(features)), [len(f) for f in features])
    kinds = len(features)
    del features, parts
    weights, bias = np.zeros(len(names)), -3.0
    laid = Chain.of(lengths)
    tags = np.zeros((WINDOW, laid.windows), np.int64)
    tags[laid.row, laid.column] = label.astype(np.int64)
    pairs = laid.inside[1:]
    observed = np.bincount((tags[:-1] * 2 + tags[1:])[pairs], minlength=4).reshape(2, 2).astype(np.float64)
    m1, m2 = np.zeros_like(weights), np.zeros_like(weights)
    t1, t2 = np.zeros((2, 2)), np.zeros((2, 2))
    b1 = b2 = 0.0
    scale = 1 / max(label.sum(), 1)
    for step in range(1, rounds + 1):
        scores = (bias + np.bincount(owner, weights[flat_features], kinds))[token]
        marginals, expected, _ = laid.marginals(scores, transitions, counts=True)
        by_type = np.bincount(token, label - marginals, kinds)
        gradient = scale * np.bincount(flat_features, by_type[owner], len(weights)) - l2 * weights
        g2 = scale * (observed - expected) - l2 * transitions
        m1, m2 = 0.9 * m1 + 0.1 * gradient, 0.99 * m2 + 0.01 * gradient ** 2
        t1, t2 = 0.9 * t1 + 0.1 * g2, 0.99 * t2 + 0.01 * g2 ** 2
        g3 = scale * (label - marginals).sum()
        b1, b2 = 0.9 * b1 + 0.1 * g3, 0.99 * b2 + 0.01 * g3 ** 2
        c1, c2 = 1 - 0.9 ** step, 1 - 0.99 ** step
        weights = weights + 0.15 * (m1 / c1) / (np.sqrt(m2 / c2) + 1e-8)
        transitions = transitions + 0.15 * (t1 / c1) / (np.sqrt(t2 / c2) + 1e-8)
        bias += 0.15 * (b1 / c1) / (np.sqrt(b2 / c2) + 1e-8)
    scores = (bias + np.bincount(owner, weights[flat_features], kinds))[token]
    marginals = laid.marginals(scores, transitions)
    clean = np.repeat(toxic == 0, lengths)
    tagger = Tagger({f: float(weights[i]) for f, i in names.items()}, float(bias), transitions, float(marginals[clean].sum() / max(clean.sum(), 1)), np.zeros(EVIDENCE + 1))
    scores = tagger.scorer()
    x = []
    for s in split_by_size(np.array([len(t) for t in texts]), CHUNK):
        x += [e for _, _, e in tagger.evidence(texts[s], scores)]
    tagger.coefficients = _logistic(np.array(x), toxic.astype(np.float64), prior)
    return tagger


def _logistic(x: np.ndarray, y: np.ndarray, prior: float, l2: float = 1e-3) -> np.ndarray:
    """Logistic regression by Newton steps, rows weighted to the prior; evidence never lowers the score."""
    x = np.c_[x, np.ones(len(x))]
    share = y.mean()
    w = np.where(y > 0, prior / share, (1 - prior) / (1 - share))
    beta = np.zeros(x.shape[1])
    free = np.ones(x.shape[1], bool)
    for _ in range(4):
        beta[~free] = 0
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            penalty = l2 * len(x) * np.r_[np.full(x.shape[1] - 1, 1e-1), 1e-6]
            g = x.T @ (w * (y - p)) - penalty * beta
            h = (x * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
            beta[free] += np.linalg.solve(h[np.ix_(free, free)], g[free])
        bad = beta[:-1] < 0
        if not bad.any():
            break
        free[:-1] &= ~bad
    beta[:-1] = np.maximum(beta[:-1], 0)
    return beta


def train(docs: DataFrame, labels: DataFrame, learn: Column, *, id: str = "doc_id", text: str = "text", label: str = "toxic",
          sample_docs: int = 800, **options) -> Tagger:
    """Fit on at most ``sample_docs`` labelled documents of each class, those of the smallest id hashes.

    Only label rows where ``learn`` holds are read; null ids and labels are left out, several
    labels of one id count as toxic if one is, and several rows of one id are all used.
    """
    own = (labels.where(learn & F.col(label).isNotNull() & F.col(id).isNotNull())
           .groupBy(F.col(id).alias("id")).agg((F.max(label) > 0).cast("int").alias("toxic")))
    spark = docs.sparkSession
    total = {r["toxic"]: r["n"] for r in own.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    picked = [r for c in (0, 1) for r in own.where(F.col("toxic") == c).orderBy(F.xxhash64("id", F.lit(11)), "id").limit(sample_docs).collect()]
    prior = total.get(1, 0) / max(sum(total.values()), 1)
    if not picked:
        return fit([], np.zeros(0, np.int64), prior)
    # at most 2 * sample_docs rows
    few = F.broadcast(spark.createDataFrame(picked, own.schema))
    rows = docs.join(few, F.col(id) == few["id"]).select(F.col(id).cast("string").alias("id"), "toxic", F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            sample = pa.Table.from_batches(held).to_pandas().drop_duplicates("text").sort_values(["id", "text"])
            model = fit(sample["text"].tolist(), sample["toxic"].to_numpy(np.int64), prior, **options)
        else:                               # labels of no document at hand
            model = fit([], np.zeros(0, np.int64), prior)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    # the bounded sample is fitted in one task, which spares the driver's memory
    return pickle.loads(rows.repartition(1).mapInArrow(run, "model binary").first()["model"])


def scorer(docs: DataFrame, tagger: Tagger, threshold: float = 0.7):
    """Column function text -> struct(score, predicted, toxic_words, spans)."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(tagger)

    @F.pandas_udf("score double, predicted int, toxic_words double, spans array<struct<start: bigint, end: bigint>>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scores = held.value.scorer()
        for texts in batches:
            yield held.value.predict(texts.tolist(), scores, threshold)

    return score


def tag(docs: DataFrame, tagger: Tagger, *, text: str = "text", into: str = "toxicity", threshold: float = 0.7) -> DataFrame:
    """All rows with a struct column ``into``: score, predicted, toxic_words, spans.

    Null and empty texts get the score of a text without evidence and no spans.  Equal texts
    get equal answers, also in repeated rows; texts of any length are scored whole.  An existing column ``into`` is replaced, other columns stay.
    """
    return docs.withColumn(into, scorer(docs, tagger, threshold)(F.col(text)))
