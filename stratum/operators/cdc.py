"""Change-data-capture operators: SCD type 1 and type 2 tables from change events.

Semantics (batch; the streaming flows give the same answer over all events so far):

* Events with a NULL key or NULL sequence are set aside (see :func:`invalid_events`).
* One version per distinct (keys, sequence).  Several events with the same
  (keys, sequence) collapse deterministically: full-row updates keep the row with
  the greatest business-column tuple (NULL lowest); partial updates keep, per
  column, the greatest non-NULL value.
* Partial updates (``ignore_null_updates``): a NULL means "unchanged", so each
  column carries the last non-NULL value forward in sequence order.
* Type 2: ``__START_AT`` = sequence, ``__END_AT`` = next sequence of the same key,
  NULL for the current version.  Late events need no special case -- the order is
  the sequence, not arrival.
* Type 1: the version with the greatest sequence per key.

Skew: one key may own a large share of all events.  Type 1 is a partial
(map-side combined) aggregate, so a hot key never lands whole in one task.  Type 2
needs ordered scans per key; the timeline of a key with too many events is cut into
as many sequence ranges as it needs, where its own events say
(:mod:`stratum.operators.ranges`).  Each (key, range) group is scanned on its own and
the edges are stitched with a small per-(key, range) summary, which keeps results exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators import ranges

START_AT = "__START_AT"
END_AT = "__END_AT"

_CHUNK = "__chunk"


def _as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def invalid_events(events: DataFrame, keys: str | Sequence[str], seq: str) -> DataFrame:
    """Events that cannot be placed: a NULL key part or a NULL sequence."""
    keys = _as_list(keys)
    bad = F.col(seq).isNull()
    for k in keys:
        bad = bad | F.col(k).isNull()
    return events.where(bad)


def valid_events(events: DataFrame, keys: str | Sequence[str], seq: str) -> DataFrame:
    keys = _as_list(keys)
    ok = F.col(seq).isNotNull()
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return events.where(ok)


def scd1(events: DataFrame, keys: str | Sequence[str], seq: str,
         except_cols: Sequence[str] = ()) -> DataFrame:
    """Current state per key: the event with the greatest sequence wins.

    Ties on (key, sequence) are broken by the greatest business-column tuple.
    A single partial aggregate; no window, no full-group collection.
    """
    keys = _as_list(keys)
    ev = valid_events(events, keys, seq)
    business = [c for c in ev.columns if c not in keys and c != seq]
    latest = (ev.groupBy(*keys)
              .agg(F.max(F.struct(F.col(seq).alias("__seq"), *business)).alias("__row"))
              .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in business]))
    return latest.drop(*[c for c in except_cols if c in latest.columns])


def sequence_splits(events: DataFrame, seq: str, chunks: int,
                    rel_error: float = 0.001) -> list[float]:
    """Approximate quantile boundaries of the sequence (as epoch micros / numbers)."""
    if chunks <= 1:
        return []
    probs = [i / chunks for i in range(1, chunks)]
    num = events.select(_seq_number(F.col(seq), events.schema[seq].dataType).cast("double").alias("s")).where("s IS NOT NULL")
    qs = num.approxQuantile("s", probs, rel_error)
    return sorted(set(float(q) for q in qs if q is not None))


def _seq_number(c: Column, dtype) -> Column:
    name = dtype.typeName()
    if name == "timestamp":
        return F.unix_micros(c)
    if name == "timestamp_ntz":
        # pure arithmetic, so the mapping is monotonic whatever the session time zone
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    if name == "date":
        return F.unix_date(c).cast("long")
    if name in ("string", "binary", "char", "varchar"):
        # the first six bytes as a number: rises with the text's byte order, which Spark sorts by
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if name == "struct":                    # sorted by its first field before all others
        return _seq_number(c[dtype.fields[0].name], dtype.fields[0].dataType)
    return c.cast("double")


def scd2(events: DataFrame, keys: str | Sequence[str], seq: str, *,
         partial: bool = False, except_cols: Sequence[str] = (),
         chunks: int = 1, hot_rows: int | None = None, clustered: bool = False,
         start_col: str = START_AT, end_col: str = END_AT) -> DataFrame:
    """Full version history (SCD type 2) from change events.

    With ``chunks > 1`` keys of more than ``hot_rows`` events (default: session setting,
    see :mod:`stratum.operators.skew`) are cut into ranges of about that many; ``0`` cuts
    the largest key into ``chunks`` ranges and others by the same limit.  ``clustered``: the
    events come from a shuffle by ``keys``; partial mode then makes no other unless a key is cut.

    One hash exchange on ``(keys, chunk)`` and one sort serve the whole
    computation: a first window (ordered by sequence, then business columns
    descending) keeps one row per (key, sequence) -- in partial mode the peers
    of a sequence have that same order and each column takes its first non-NULL
    value in it -- and a second window over the same order gives ``lead`` and the
    forward fill.  No task holds all versions of a hot key (module doc).
    """
    keys = _as_list(keys)
    valid = valid_events(events, keys, seq)
    business = [c for c in valid.columns if c not in keys and c != seq]
    # narrow passes over the keys and the sequence, before any shuffle of the events
    hot = ranges.hot_keys(valid, keys, hot_rows, chunks) if chunks > 1 else None
    ev = hot.ranges(F.col(seq)).of(valid, F.col(seq), _CHUNK) if hot else valid.withColumn(_CHUNK, F.lit(0))
    part = [*keys, _CHUNK]

    # 1) one row per (key, sequence)
    if partial:
        # peers have one common order; each column takes its first non-NULL value in it.  The
        # shuffle on (keys, chunk) comes first, so both windows share it and its sort.
        if hot or not clustered:
            ev = ev.repartition(*part)
        w0 = Window.partitionBy(*part, seq).orderBy(*[F.col(c).desc_nulls_last() for c in business])
        peers = w0.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ev = ev.select(*part, seq, *[F.first(c, ignorenulls=True).over(peers).alias(c) for c in business],
                       F.row_number().over(w0).alias("__peer")).where("__peer = 1").drop("__peer")
        w1 = Window.partitionBy(*part).orderBy(seq)
        merged = [F.col(c) for c in business]
    else:
        w1 = Window.partitionBy(*part).orderBy(
            F.col(seq).asc(), *[F.col(c).desc_nulls_last() for c in business])
        merged = [F.col(c) for c in business]
    one = (ev.select(*part, seq, *merged, F.lag(seq).over(w1).alias("__prev"))
           .where(F.col("__prev").isNull() | (F.col("__prev") != F.col(seq)))
           .drop("__prev"))

    # 2) next sequence and forward fill inside each (key, chunk)
    w2 = Window.partitionBy(*part).orderBy(seq)
    filled = [F.last(c, ignorenulls=True).over(
        w2.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(c)
        for c in business] if partial else [F.col(c) for c in business]
    local = [F.lead(seq).over(w2).alias("__next_local")]
    if hot:
        local.append(F.min(seq).over(
            w2.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__first"))
    scanned = one.select(*part, seq, *filled, *local)

    if not hot:
        out = scanned.withColumn("__next", F.col("__next_local"))
    else:
        # 3) stitch chunk edges.  Only the last row of each (key, chunk) needs a
        #    new end (the next chunk's first sequence): a window over just those
        #    rows, one per range.  In partial mode rows that still hold
        #    a NULL after the local fill take the last non-NULL value of earlier
        #    chunks; only those rows are joined with the small carry table.
        w_chunks = Window.partitionBy(*keys).orderBy(_CHUNK)
        w_before = w_chunks.rowsBetween(Window.unboundedPreceding, -1)
        is_last = F.col("__next_local").isNull()
        edges = scanned.where(is_last).select(
            "*", F.lead("__first").over(w_chunks).alias("__next_chunk_first"),
            *([F.last(c, ignorenulls=True).over(w_before).alias(f"__carry_{c}") for c in business]
              if partial else []))
        inner = scanned.where(~is_last).withColumn("__next", F.col("__next_local"))
        last_rows = edges.select(*part, seq, *business,
                                 F.col("__next_chunk_first").alias("__next"),
                                 *[f"__carry_{c}" for c in business] if partial else [])
        if not partial:
            out = inner.select(*part, seq, *business, "__next").unionByName(
                last_rows.select(*part, seq, *business, "__next"))
        else:
            carry = edges.select(*part, *[f"__carry_{c}" for c in business])
            has_null = F.lit(False)
            for c in business:
                has_null = has_null | F.col(c).isNull()
            complete = inner.where(~has_null).select(*part, seq, *business, "__next")
            gaps = (inner.where(has_null).select(*part, seq, *business, "__next")
                    .join(carry, part, "left"))
            fill = lambda df: df.select(
                *part, seq, *[F.coalesce(F.col(c), F.col(f"__carry_{c}")).alias(c) for c in business],
                "__next")
            out = complete.unionByName(fill(gaps)).unionByName(fill(last_rows))

    out = out.select(*keys, *business, F.col(seq),
                     F.col(seq).alias(start_col), F.col("__next").alias(end_col))
    drop = [c for c in except_cols if c in out.columns]
    return out.drop(*drop)


def current_versions(history: DataFrame, end_col: str = END_AT) -> DataFrame:
    """Rows of an SCD2 table that are current (``__END_AT IS NULL``)."""
    return history.where(F.col(end_col).isNull())
