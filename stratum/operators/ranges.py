"""Ordered groups cut into ranges, as many as each group needs.

Work in a group's order (versions of a key, windows of a member, a rank over everything) puts a whole
group into one task.  Here a group that holds more than ``limit`` rows is cut where its own rows say:

1. one pass with a frequent-items sketch names the groups above the limit (by a 64-bit hash);
2. the rows of these groups alone are counted per (group, order value) -- combined map-side, so ties
   shrink -- and written, spread by ranges of (group, value) over as many tasks as their number asks for;
3. counts per (group, task) give each task's offset, running sums inside a task the rest: every value
   knows how many rows of its group come before it (:func:`prefix_counts`);
4. a range ends where this number passes a multiple of the limit.  So a range holds at most ``limit``
   rows and the repeats of its last value, in a burst as in a quiet stretch, whatever the value's type.

The limit is raised to ``rows / MOST_RANGES`` on very large inputs: all tables together have fewer than
``2 * MOST_RANGES`` range starts, which bounds what is broadcast.  Groups whose hashes are equal share
their starts, which cuts them more often and changes no result.  NULL order values are in the first range, as
Spark sorts them.  The written counts make the ranges the same whenever a task runs again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators import skew
from stratum.session import materialize

MOST_RANGES = 32_768
TRACKED_ITEMS = 250_000     # the sketch finds every group of more than rows / MOST_RANGES rows
TASK_ROWS = 1_000_000       # order values that one task sorts

BUCKET = "__bucket"
BEFORE = "__before"
TOTAL = "__n"


def prefix_counts(counts: DataFrame, group: Sequence[str], order: str, n: str, *,
                  task_rows: int = TASK_ROWS, least: int = 1) -> DataFrame:
    """``counts`` (one row per group and order value) with ``__before``, the sum of ``n`` over the
    lower values of the group (NULL lowest), and ``__n``, the sum over the group.

    The values are written and spread by range over ``rows / task_rows`` buckets (at least ``least``),
    so a task sorts a bounded number of them however many there are; with no ``group``, one row
    per bucket is all that meets in a single task.
    """
    values = materialize(counts.withColumn(BUCKET, F.lit(0)), "values")
    buckets = max(least, -(-values.count() // task_rows))      # a written table's count reads footers only
    if buckets > 1:
        spread = values.repartitionByRange(buckets, *group, order)
        values = materialize(spread.withColumn(BUCKET, F.spark_partition_id()), "spread-values")
    earlier = Window.partitionBy(*group).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = values.groupBy(*group, BUCKET).agg(F.sum(n).alias("__bcnt")).select(
        *group, BUCKET, F.coalesce(F.sum("__bcnt").over(earlier), F.lit(0)).alias("__offset"),
        F.sum("__bcnt").over(Window.partitionBy(*group)).alias(TOTAL))
    lower = Window.partitionBy(*group, BUCKET).orderBy(F.col(order).asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)
    return (values.withColumn("__lower", F.coalesce(F.sum(n).over(lower), F.lit(0)))
            .join(offsets, [*group, BUCKET])
            .select(*counts.columns, (F.col("__offset") + F.col("__lower")).alias(BEFORE), TOTAL))


@dataclass(frozen=True)
class Ranges:
    """Where the ranges of each cut group start (``__h``, ``__starts`` in ascending order)."""
    keys: tuple[str, ...]
    starts: DataFrame
    most: int                   # ranges of one group, at most

    def of(self, df: DataFrame, order: Column, out: str) -> DataFrame:
        """``df`` with the number of each row's range: 0 in groups that are not cut.

        The starts are broadcast (bounded, see above) and searched by halving steps, so the rows
        do not move."""
        steps = [1 << i for i in reversed(range(self.most.bit_length()))]
        starts = F.col("__starts")
        found = F.aggregate(
            F.array(*[F.lit(s) for s in steps]), F.lit(0),
            lambda at, step: F.when((at + step <= F.size(starts)) & (F.get(starts, at + step - 1) <= F.col("__o")),
                                    at + step).otherwise(at))
        marked = df.select("*", F.xxhash64(*self.keys).alias("__h"), order.alias("__o"))
        return (marked.join(F.broadcast(self.starts), "__h", "left")
                .withColumn(out, F.when(starts.isNull(), F.lit(0)).otherwise(found))
                .drop("__h", "__o", "__starts"))


@dataclass(frozen=True)
class HotKeys:
    """Groups of ``df`` with more than ``limit`` rows, by hash."""
    df: DataFrame
    keys: tuple[str, ...]
    hashes: tuple[int, ...]
    largest: int
    limit: int

    def ranges(self, order: Column, *, task_rows: int = TASK_ROWS) -> Ranges:
        spark = self.df.sparkSession
        hot = spark.createDataFrame([(h,) for h in self.hashes], "__h long")
        counts = (self.df.select(F.xxhash64(*self.keys).alias("__h"), order.alias("__o"))
                  .join(F.broadcast(hot), "__h", "left_semi")
                  .groupBy("__h", "__o").agg(F.count(F.lit(1)).alias("__cnt")))
        placed = prefix_counts(counts, ["__h"], "__o", "__cnt", task_rows=task_rows)
        starts = (placed.groupBy("__h", F.expr(f"{BEFORE} div {self.limit}").alias("__range")).agg(F.min("__o").alias("__o"))
                  .where("__range > 0")
                  .groupBy("__h").agg(F.sort_array(F.collect_list("__o")).alias("__starts")))
        return Ranges(self.keys, starts, -(-self.largest // self.limit))


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int | None = None, pieces: int = 16) -> HotKeys | None:
    """The groups above ``limit`` rows (default: the session's ``spark.stratum.hotGroupRows``), None where
    there are none.  ``limit=0`` takes the limit that cuts the largest group into ``pieces``."""
    limit = skew.hot_rows(df) if limit is None else limit
    if limit > 0 and df.count() <= limit:       # no group has more rows than the table
        return None
    rows, top = df.select(F.xxhash64(*keys).alias("__h")).agg(
        F.count(F.lit(1)), F.expr(f"approx_top_k(__h, {MOST_RANGES}, {TRACKED_ITEMS})")).first()
    if not top:
        return None
    largest = int(top[0]["count"])
    if limit <= 0:
        limit = max(1, -(-largest // pieces))
    limit = max(limit, -(-rows // MOST_RANGES))
    hashes = tuple(t["item"] for t in top if t["count"] > limit)
    return HotKeys(df, tuple(keys), hashes, largest, limit) if hashes else None
