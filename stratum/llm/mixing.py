"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic).  The cells' token weights are raked in
turn to the target marginals of source, language and topic until all three hold, and each
document is kept with its cell's calibrated probability: target share of the cell times the
token budget, over the tokens that the cell has, at most 1.  What a full cell cannot give is
spread over the others until the budget is met.  Everything is DataFrame work on the table
of cells; sums are combined before each shuffle, and no cell is ever collected.

Where there is no ``topic`` column, a document's form stands for it (see ``form_topic``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stratum.llm.common import WORD_SPACE, Scratch, free_name

DIMENSIONS = ("source", "lang", "topic")
MISSING = "(none)"


def n_words(text: Column) -> Column:
    """Runs without white space; 0 for null."""
    squeezed = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "w")
    return F.length(F.translate(squeezed, WORD_SPACE, "")).cast("long")


def form_topic(text: Column) -> Column:
    """tabular, symbols, long or prose: the form of the whole text, from its separators, symbols and length."""
    whole = F.coalesce(text, F.lit(""))
    size = F.length(whole)
    share = lambda chars: size - F.length(F.translate(whole, chars, ""))
    return (F.when(share("|") * 100 > size, "tabular").when(share("#*$%&") * 50 > size, "symbols")
            .when(size > 4000, "long").otherwise("prose"))


def power_targets(cells: DataFrame, powers: dict[str, float]) -> DataFrame:
    """dimension, value, share: each value's share of the tokens to the given power, scaled to 1 (1: as it is, 0: all equal)."""
    out = None
    for d in DIMENSIONS:
        own = cells.groupBy(F.col(d).alias("value")).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
        raised = own.select("value", F.pow("tokens", F.lit(float(powers[d]))).alias("p"))
        total = raised.agg(F.sum("p")).first()[0] or 1.0
        shares = raised.select(F.lit(d).alias("dimension"), "value", (F.col("p") / F.lit(total)).alias("share"))
        out = shares if out is None else out.union(shares)
    return out


def widened(cells: DataFrame, targets: DataFrame, by: float) -> DataFrame:
    """Targets moved by this part of the way to the shares that the tokens have as they are."""
    own = power_targets(cells, dict.fromkeys(DIMENSIONS, 1.0)).withColumnRenamed("share", "own")
    both = targets.join(own, ["dimension", "value"], "full")
    zero = F.lit(0.0)
    return both.select("dimension", "value", (F.coalesce("share", zero) * (1 - by) + F.coalesce("own", zero) * by).alias("share"))


def rake(cells: DataFrame, targets: DataFrame, scratch: Scratch, *, tolerance: float = 1e-6, rounds: int = 40) -> tuple[DataFrame, float]:
    """Cells with ``weight``, whose sums by source, lang and topic are the targets' shares; by how much a share is off at most.

    Each round scales the weights to the three marginals in turn and writes the cells after each; it
    ends when no marginal is off by more than ``tolerance``, when the rounds no longer change
    that (the targets contradict each other), or after ``rounds``.  Values without tokens have no cells; targets for them are ignored and the others scaled to 1.
    """
    present = None
    for d in DIMENSIONS:
        own = cells.where("tokens > 0").select(F.lit(d).alias("dimension"), F.col(d).alias("value")).distinct()
        present = own if present is None else present.union(own)
    usable = targets.join(present, ["dimension", "value"], "left_semi").where("share > 0")
    scale = usable.groupBy("dimension").agg(F.sum("share").alias("all"))
    usable = scratch.keep(usable.join(F.broadcast(scale), "dimension").select("dimension", "value", (F.col("share") / F.col("all")).alias("share")), "targets")
    wanted = {d: usable.where(F.col("dimension") == d).select(F.col("value").alias(d), "share") for d in DIMENSIONS}
    now = scratch.keep(cells.withColumn("weight", F.col("tokens").cast("double")).withColumn("off", F.lit(0.0)), "raked")
    worst = 0.0
    for k in range(rounds):
        for d in DIMENSIONS:
            sums = now.groupBy(d).agg(F.sum("weight").alias("have")).join(wanted[d], d, "left").select(
                d, "have", F.coalesce("share", F.lit(0.0)).alias("share"))
            factor = F.when(F.col("have") > 0, F.col("share") / F.col("have")).otherwise(0.0)
            worse = F.lit(0.0) if d == DIMENSIONS[0] else F.col("off")
            # written after each marginal: each joins the cells to their own sums, so the plan of a whole round would read them 2^3 times
            step = scratch.keep(now.join(sums, d).select(*DIMENSIONS, "docs", "tokens", (F.col("weight") * factor).alias("weight"),
                                                         F.greatest(worse, F.abs(F.col("have") - F.col("share"))).alias("off")), "raked")
            scratch.drop(now)
            now = step
        before, worst = worst, now.agg(F.max("off")).first()[0] or 0.0
        if worst <= tolerance or k > 2 and worst > 0.999 * before:
            break
        if k % 8 == 7:
            scratch.release()
    return now.drop("off"), worst


def probabilities(raked: DataFrame, budget: float, rounds: int = 30) -> DataFrame:
    """source, lang, topic, weight, prob: min(1, scale * weight / tokens) with the scale at which ``budget`` tokens are expected.

    The scale rises while cells that are full (probability 1) leave part of the budget over.
    """
    def sums(scale: float | None) -> tuple[float, float]:
        full = F.lit(False) if scale is None else F.col("weight") * scale >= F.col("tokens")
        row = raked.agg(F.sum(F.when(full, F.col("tokens").cast("double")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        return row[0] or 0.0, row[1] or 0.0

    scale = None
    for _ in range(rounds):
        full, rest = sums(scale)
        if rest <= 0:
            break
        new = max((budget - full) / rest, scale or 0.0)
        if scale is not None and new <= scale * (1 + 1e-12):
            break
        scale = new
    prob = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("weight") * F.lit(scale or 0.0) / F.col("tokens"))).otherwise(F.lit(1.0))
    return raked.select(*DIMENSIONS, "weight", prob.alias("prob"))


def draw(id: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone (md5 of both as text; null: the empty text)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(16 ** 13)


def _value(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(MISSING))


def cell_probabilities(rows: DataFrame, scratch: Scratch, powers: dict[str, float] | None, targets: DataFrame | None, keep: float,
                       tolerance: float = 1e-6) -> DataFrame:
    """source, lang, topic, weight, prob of every cell of ``rows`` (source, lang, topic, n_words).

    Given targets that no weights meet raise an error.  Targets made of ``powers`` move towards the
    shares as they are, a quarter of the way at a time, until weights meet them (they do at the end).
    """
    spark = rows.sparkSession
    cells = scratch.keep(rows.groupBy(*DIMENSIONS).agg(F.count("*").alias("docs"), F.sum("n_words").alias("tokens")), "cells")
    wanted = targets if targets is not None else power_targets(cells, powers or {"source": 0.8, "lang": 0.8, "topic": 0.8})
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    text = spark.conf.get("spark.sql.maxPlanStringLength")
    spark.conf.set("spark.sql.maxPlanStringLength", "2000")     # the rounds' plans are alike: the driver need not keep their text
    try:
        for by in (0.0, 0.25, 0.5, 0.75, 1.0):
            raked, worst = rake(cells, widened(cells, wanted, by) if by else wanted, scratch, tolerance=tolerance)
            if worst <= tolerance:
                break
            if targets is not None:
                raise ValueError(f"no weights meet the targets: a share stays off by {worst:.3g}")
        out = scratch.keep(probabilities(raked, keep * total), "probabilities")
    finally:
        spark.conf.set("spark.sql.maxPlanStringLength", text)
    scratch.release()
    return out


def mix(docs: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", topic: str | None = None,
        powers: dict[str, float] | None = None, targets: DataFrame | None = None, keep: float = 0.7, seed: int = 5) -> DataFrame:
    """``id``, source, lang, topic, n_words, weight, prob, sampled for every row.

    ``targets`` (dimension, value, share) or ``powers`` of the present shares give the
    marginals; ``keep`` is the share of all tokens to expect in the sample.  A null source,
    language or topic is a value of its own.  Rows without words have no weight: their
    probability is their cell's, or 1 in a cell without words.  Rows that repeat an id are
    kept or dropped together where their cells agree.  Texts of any length are counted whole.
    Targets that cannot be met raise an error, or are widened (see ``cell_probabilities``).
    Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = scratch.keep(docs.select(
        F.col(id).alias("id"), _value(source).alias("source"), _value(lang).alias("lang"),
        (_value(topic) if topic else form_topic(F.col(text))).alias("topic"), n_words(F.col(text)).alias("n_words")), "rows")
    prob = cell_probabilities(rows, scratch, powers, targets, keep)
    return rows.join(prob, list(DIMENSIONS)).select(
        F.col("id").alias(id), *DIMENSIONS, "n_words", "weight", "prob", (draw(F.col("id"), seed) < F.col("prob")).alias("sampled"))


def sample(docs: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", topic: str | None = None,
           powers: dict[str, float] | None = None, targets: DataFrame | None = None, keep: float = 0.7, seed: int = 5) -> DataFrame:
    """The rows that ``mix`` samples, with all columns as they are.

    The table of cells is joined to the documents; where it is large, the join is split by
    Spark's handling of skewed keys.
    """
    scratch = Scratch(docs.sparkSession, "sampling")
    form = _value(topic) if topic else form_topic(F.col(text))
    rows = docs.select(_value(source).alias("source"), _value(lang).alias("lang"), form.alias("topic"), n_words(F.col(text)).alias("n_words"))
    prob = cell_probabilities(rows, scratch, powers, targets, keep)
    key, chance = free_name(docs, "cell"), free_name(docs, "chance")
    cell = lambda *parts: F.struct(*parts)
    chances = prob.select(cell("source", "lang", "topic").alias(key), F.col("prob").alias(chance))
    keyed = docs.withColumn(key, cell(_value(source).alias("source"), _value(lang).alias("lang"), form.alias("topic")))
    return keyed.join(chances, key).where(draw(F.col(id), seed) < F.col(chance)).select(*[docs[c] for c in docs.columns])
