"""Timestamps and clean numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOT_SECONDS = 900


def compact_timestamp(text: Column | str) -> Column:
    """``yyyyMMddHHmmss`` to a timestamp; null when it does not parse."""
    return F.try_to_timestamp(_col(text).cast("string"), F.lit("yyyyMMddHHmmss"))


def compact_date(text: Column | str) -> Column:
    """``yyyyMMdd`` to a date; null when it does not parse."""
    return F.try_to_timestamp(_col(text).cast("string"), F.lit("yyyyMMdd")).cast("date")


def floor_slot(ts: Column | str, seconds: Column | int = SLOT_SECONDS) -> Column:
    """Start of the fixed-width slot that holds ``ts``."""
    seconds = seconds if isinstance(seconds, Column) else F.lit(seconds)
    epoch = F.unix_seconds(_col(ts).cast("timestamp"))
    return F.timestamp_seconds(epoch - F.pmod(epoch, seconds))


def bucket_number(ts: Column | str, seconds: int) -> Column:
    """Number of the fixed-width bucket (UTC) that holds ``ts``, counted from 1970."""
    epoch = F.unix_seconds(_col(ts).cast("timestamp"))
    return F.floor(epoch / F.lit(seconds)).cast("long")


def iso8601(ts: Column | str) -> Column:
    """UTC text such as ``2026-02-16T00:00:00Z``."""
    return F.date_format(_col(ts).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def finite_or_null(x: Column | str) -> Column:
    """Null in place of NaN and the infinities."""
    x = _col(x)
    infinite = F.abs(x) == F.lit(float("inf"))
    return F.when(~(F.isnan(x) | infinite), x)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
