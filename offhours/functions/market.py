"""Candle expressions: range, change, direction, and the smoothed score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def candle_range(high: Column | str = "High", low: Column | str = "Low") -> Column:
    return F.round(_col(high) - _col(low), 4)


def percent_change(value: Column | str, previous: Column | str) -> Column:
    """Change in percent; null without a predecessor or after a zero."""
    return F.try_divide(_col(value) - _col(previous), _col(previous)) * 100


def candle_direction(open_: Column | str = "Open", close: Column | str = "Close") -> Column:
    """``up`` when the close is at or above the open, otherwise ``down``."""
    return F.when(_col(close) >= _col(open_), F.lit("up")).otherwise(F.lit("down"))


def hybrid(peak: Column | str, mean: Column | str, alpha: Column | float) -> Column:
    """``alpha`` parts peak, the rest mean."""
    alpha = alpha if isinstance(alpha, Column) else F.lit(alpha)
    return alpha * _col(peak) + (1 - alpha) * _col(mean)


def position_in_range(value: Column, low: Column, high: Column, flat: float = 50.0) -> Column:
    """Min-max position in percent; ``flat`` when the range is a single value."""
    scaled = (value - low) / (high - low) * 100
    return F.round(F.when(high > low, scaled).otherwise(F.lit(flat)), 2)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
