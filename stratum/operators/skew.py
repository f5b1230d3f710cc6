"""Choosing between a plain per-group plan and the split (hot-group) plan.

Ordered per-group work (SCD2 versions, member windows) needs each group's rows
in order.  When no group is large, one task per group is the cheapest plan;
when a group is huge it must be split.  The decision is made from the estimated
largest group -- one sketch aggregate producing a single row -- against a
bound on the rows one task should sort (``spark.stratum.hotGroupRows``).
Results are identical either way; only the plan differs.  :func:`dealt` bounds the
rows of a task where no single group is large but many groups meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS_CONF = "spark.stratum.hotGroupRows"
DEFAULT_HOT_ROWS = 2_000_000
TASK_ROWS_CONF = "spark.stratum.taskRows"
DEFAULT_TASK_ROWS = 500_000


def hot_rows(df: DataFrame) -> int:
    v = df.sparkSession.conf.get(HOT_ROWS_CONF, None)
    return int(v) if v else DEFAULT_HOT_ROWS


TRACKED_ITEMS = 100_000


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Estimated row count of the largest group (0 for empty input).

    A frequent-items sketch (``approx_top_k``) over a 64-bit hash of the keys:
    one pass, partial sketches merged, no shuffle of the keys.  Counts are
    upper bounds, and every group above ``rows / TRACKED_ITEMS`` is found, so
    the estimate errs toward splitting.
    """
    top = (df.select(F.xxhash64(*[F.col(k) for k in keys]).alias("__h"))
           .agg(F.expr(f"approx_top_k(__h, 1, {TRACKED_ITEMS})").alias("__t")).first()[0])
    return int(top[0]["count"]) if top else 0


def needs_split(df: DataFrame, keys: Sequence[str], threshold: int | None = None) -> bool:
    """True when some group exceeds ``threshold`` rows (default from the session).

    ``threshold=0`` always splits (used to exercise the split plan in tests)."""
    limit = hot_rows(df) if threshold is None else threshold
    if limit <= 0:
        return True
    if df.count() <= limit:                 # no group has more rows than the table; a scan's count reads no rows
        return False
    return largest_group(df, keys) > limit


def dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` shuffled by ``keys`` into tasks of about ``spark.stratum.taskRows`` rows (default 500,000).

    For steps that hold a task's rows in memory several times over: the number of tasks follows
    the table, not a session setting, and they are not joined again by their compressed size.
    Joins and aggregates on the keys keep this shuffle.  Up to that many rows ``df`` is returned
    as it is, so small tables keep their broadcast joins.  Rows of one key stay together.
    """
    spark = df.sparkSession
    limit = int(spark.conf.get(TASK_ROWS_CONF, None) or DEFAULT_TASK_ROWS)
    rows = df.count()                       # a Parquet table's: read from the footers
    if rows <= limit:
        return df
    return df.repartition(max(-(-rows // limit), spark.sparkContext.defaultParallelism), *keys)
