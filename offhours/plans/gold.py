"""Clean candles and events to the stress index, one row per candle and country."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offhours.functions.market import position_in_range
from offhours.operators.merge import days_around, replace_day
from offhours.operators.ordered import DAY_SECONDS, next_open, rolling_measures, with_position
from offhours.operators.slots import join_timeline, slot_scores, smooth_periods
from offhours.schemas import GOLD


@dataclass(frozen=True)
class GoldRules:
    """Weight of the peak in the smoothing, rows the rolling window looks back on, bucket length.

    ``bucket_seconds`` is how much of the series one task may have to order; series
    finer than a second take less than a day. The results do not depend on it.
    """

    alpha: float = 0.25
    window_rows: int = 672
    floor_slots: bool = False
    bucket_seconds: int = DAY_SECONDS


def open_candles(candles: DataFrame) -> DataFrame:
    """Candles that have both a timestamp and a closing price."""
    return candles.where(F.col("Datetime").isNotNull() & F.col("Close").isNotNull())


def assign_periods(
    candles: DataFrame, slots: DataFrame, bucket_seconds: int = DAY_SECONDS
) -> DataFrame:
    """The joined timeline with the candle each row counts towards.

    Rows after the last open candle count towards none and are dropped.
    """
    stamped = candles.where(F.col("Datetime").isNotNull())
    timeline = join_timeline(stamped, slots)
    opens = open_candles(candles).select("Datetime")
    assigned = next_open(timeline, opens, bucket_seconds=bucket_seconds)
    return assigned.where(F.col("target_open_datetime").isNotNull())


def rolling_score(df: DataFrame, position: str, rules: GoldRules = GoldRules()) -> DataFrame:
    """Add the min-max position of the smoothed score in the rolling window."""
    score = "geo_score_raw_smoothed"
    spread = rolling_measures(
        df, position, rules.window_rows, {"_low": ("min", score), "_high": ("max", score)}
    )
    scaled = position_in_range(F.col(score), F.col("_low"), F.col("_high"))
    return spread.withColumn("score_pct_7d", scaled).drop("_low", "_high")


def join_periods(candles: DataFrame, periods: DataFrame) -> DataFrame:
    """Candles with their smoothed period; candles without one drop out."""
    on = candles["Datetime"] == periods["target_open_datetime"]
    return candles.join(periods, on, "inner").drop("target_open_datetime")


def explode_countries(gold: DataFrame) -> DataFrame:
    """One row per candle and country; a candle without countries keeps one null row."""
    return gold.withColumn(
        "period_actor_country", F.explode_outer("period_actor_countries")
    ).drop("period_actor_countries")


def candle_scores(
    candles: DataFrame, events: DataFrame, rules: GoldRules = GoldRules(), slots: bool = False
) -> DataFrame:
    """The index before the split by country: one row per open candle.

    Every open candle gets a period (it is its own target), so its place in the
    series is already known from the candles; the rolling window needs no second
    pass over the events. ``slots`` says that ``events`` are scores per slot already.
    """
    scores = events if slots else slot_scores(events, rules.floor_slots)
    bucket = rules.bucket_seconds
    periods = smooth_periods(assign_periods(candles, scores, bucket), rules.alpha)
    placed = with_position(open_candles(candles), "Datetime", "_position", bucket_seconds=bucket)
    return rolling_score(join_periods(placed, periods), "_position", rules).drop("_position")


def stress_index(
    candles: DataFrame,
    events: DataFrame,
    rules: GoldRules = GoldRules(),
    sort: bool = False,
    slots: bool = False,
) -> DataFrame:
    """The full index over all given candles and events (or scores per slot, with ``slots``)."""
    gold = explode_countries(candle_scores(candles, events, rules, slots)).select(*GOLD.names)
    return gold.orderBy("Datetime") if sort else gold


def context_start(candles: DataFrame, day: str, rules: GoldRules = GoldRules()) -> DataFrame:
    """One row: the open candle just before the rolling window of the day begins.

    Null when the series has fewer candles before the day than the window holds.
    """
    need = rules.window_rows + 1
    before = open_candles(candles).where(F.col("Datetime") < F.lit(day).cast("timestamp"))
    latest = before.select("Datetime").orderBy(F.desc("Datetime")).limit(need)
    return latest.agg(
        F.when(F.count(F.lit(1)) == need, F.min("Datetime")).alias("start")
    )


def day_index(
    candles: DataFrame,
    events: DataFrame,
    day: str,
    rules: GoldRules = GoldRules(),
    context_days: int | None = None,
    start: dt.datetime | None = None,
    slots: bool = False,
) -> DataFrame:
    """The index of one day, computed from the context it depends on.

    By default the context is the candles the rolling window reaches back to and
    the events since then, which gives exactly the rows of the full computation.
    ``context_days`` takes that many calendar days instead, which is cheaper to
    bound but starts the window and the first closed period in the middle.

    ``start`` is the value of ``context_start``, for a caller who knows it; else it
    is found with one job, so that the plan and the scans get it as a literal.
    ``slots`` says that ``events`` are scores per slot already.
    """
    midnight = F.lit(day).cast("timestamp")
    if context_days is not None:
        candles = days_around(candles, "Datetime", day, context_days)
        events = days_around(events, "DATEADDED", day, context_days)
    else:
        start = start or context_start(candles, day, rules).first()["start"]
        end = F.expr(f"timestamp'{day}' + interval 1 day")

        def within(df: DataFrame, ts: str) -> DataFrame:
            upto = df.where(F.col(ts) < end)
            return upto.where(F.col(ts) > F.lit(start)) if start else upto

        candles, events = within(candles, "Datetime"), within(events, "DATEADDED")
    whole = stress_index(candles, events, rules, slots=slots)
    return whole.where(F.to_date("Datetime") == midnight.cast("date"))


def daily_index(
    existing: DataFrame,
    candles: DataFrame,
    events: DataFrame,
    day: str,
    rules: GoldRules = GoldRules(),
    context_days: int | None = None,
) -> DataFrame:
    """``existing`` index with one day recomputed and exchanged."""
    fresh = day_index(candles, events, day, rules, context_days)
    return replace_day(existing, fresh, "Datetime", day)
