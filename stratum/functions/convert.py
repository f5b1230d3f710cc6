"""Scalar column helpers used by the silver flows and gold views (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"

# Fixed value: dashed UUID text groups, 8-4-4-4-12 hex digits.
_UUID_GROUPS = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def uuid_text(c: str | Column, null_on_null: bool = False) -> Column:
    """16-byte binary UUID -> ``XXXXXXXX-XXXX-XXXX-XXXX-XXXXXXXXXXXX`` (upper-case hex).

    ``concat_ws`` skips NULL inputs, so a NULL UUID becomes ``''`` -- the
    reference behaviour.  ``null_on_null=True`` keeps NULL instead.
    """
    h = F.hex(_c(c))
    text = F.concat_ws("-", *[F.substring(h, pos, n) for pos, n in _UUID_GROUPS])
    if null_on_null:
        return F.when(_c(c).isNotNull(), text)
    return text


def hex_text(c: str | Column) -> Column:
    """Binary -> plain upper-case hex text."""
    return F.hex(_c(c))


def epoch_day_to_date(c: str | Column) -> Column:
    """Days since 1970-01-01 (int) -> DATE.  Negative days are before 1970."""
    return F.date_from_unix_date(_c(c).cast("int"))


def epoch_us_to_timestamp(c: str | Column) -> Column:
    """Microseconds since the epoch (bigint) -> TIMESTAMP."""
    return F.timestamp_micros(_c(c).cast("long"))


def money(c: str | Column) -> Column:
    """Cast to decimal(10,2); under ANSI mode an amount that does not fit raises."""
    return _c(c).cast(MONEY)


def sequence_of(modified: str | Column, created: str | Column, kind: str = "timestamp") -> Column:
    """Ordering column for change events: modified time, else created time.

    ``kind='timestamp'`` casts text/timestamp values; ``kind='epoch_us'`` reads
    bigint microseconds.
    """
    if kind == "epoch_us":
        return F.coalesce(epoch_us_to_timestamp(modified), epoch_us_to_timestamp(created))
    return F.coalesce(_c(modified).cast("timestamp"), _c(created).cast("timestamp"))


def cdc_struct_sequence(struct_col: str, field: str = "__cdc_timestamp_value") -> Column:
    """Sequence taken from a field of a CDC position struct."""
    return F.col(f"{struct_col}.{field}")


def guarded_pct(num: str | Column, den: str | Column, extra_cond: Column | None = None,
                otherwise: object = None) -> Column:
    """``ROUND(num / den * 100, 2)`` when ``den > 0`` (and ``extra_cond``), else ``otherwise``."""
    cond = _c(den) > 0
    if extra_cond is not None:
        cond = cond & extra_cond
    val = F.round(_c(num) / _c(den) * 100, 2)
    out = F.when(cond, val)
    if otherwise is not None:
        out = out.otherwise(F.lit(otherwise))
    return out


def days_between(end: str | Column, start: str | Column) -> Column:
    """``DATEDIFF(end, start)`` in days (int)."""
    return F.datediff(_c(end), _c(start))


def flag(cond: Column) -> Column:
    """Searched CASE giving a boolean; a NULL condition yields false."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))
