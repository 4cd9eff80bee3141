"""Date rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_floor(later: Column, earlier: Column) -> Column:
    """Whole 24-hour periods between two timestamps, rounded towards -infinity.

    Works on the exact interval, so neither the session time zone nor calendar
    boundaries play a part: -12 hours is -1, +12 hours across midnight is 0.
    """
    gap = later - earlier
    whole = F.extract(F.lit("DAY"), gap).cast("long")
    return whole - F.when(gap < F.make_dt_interval(whole.cast("int")), 1).otherwise(0)


def text_to_timestamp(x: Column, formats: tuple[str, ...] = ()) -> Column:
    """ISO text (plus any extra formats) to a zone-less timestamp, bad text to NULL."""
    parsed = [x.try_cast("timestamp_ntz")]
    parsed += [F.try_to_timestamp(x, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*parsed)


def months_before(moment: Column, months: int) -> Column:
    """The moment, ``months`` calendar months earlier."""
    return moment - F.make_ym_interval(F.lit(0), F.lit(months))
