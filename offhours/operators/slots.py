"""Slot aggregation, the joined timeline, and the smoothing of closed periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offhours.functions.market import hybrid
from offhours.functions.moments import SLOT_SECONDS, floor_slot
from offhours.schemas import SCORE_COLUMNS


def worst_countries() -> Column:
    """Countries of the highest-scoring row; ties go to the greatest list."""
    return F.max(F.struct("geo_score_raw", "actor_countries")).getField("actor_countries")


def slot_states(events: DataFrame, floor: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """Per slot what can be added up later: score sums, event count, the worst event.

    Feeds stamp events on the slot grid already; ``floor`` puts others there.
    Events without a timestamp belong to no slot and stay out. Sums, counts and
    the maximum all combine map-side, so a hot slot sends one row per task.
    """
    stamped = events.where(F.col("DATEADDED").isNotNull())
    if floor:
        stamped = stamped.withColumn("DATEADDED", floor_slot("DATEADDED"))
    return stamped.groupBy("DATEADDED", *keys).agg(
        *[F.sum(c).alias(c) for c in SCORE_COLUMNS],
        F.count(F.lit(1)).alias("event_count"),
        F.max(F.struct("geo_score_raw", "actor_countries")).alias("worst"),
    )


def merged_slots(states: DataFrame) -> DataFrame:
    """One row per slot from states of parts of its events, as `slot_scores` gives it."""
    return states.groupBy("DATEADDED").agg(
        *[F.sum(c).alias(c) for c in SCORE_COLUMNS],
        F.sum("event_count").alias("event_count"),
        F.max("worst").getField("actor_countries").alias("actor_countries"),
    )


def slot_scores(events: DataFrame, floor: bool = False) -> DataFrame:
    """One row per slot: score sums, event count, countries of the worst event."""
    states = slot_states(events, floor)
    worst = F.col("worst").getField("actor_countries").alias("actor_countries")
    return states.select("DATEADDED", *SCORE_COLUMNS, "event_count", worst)


def join_timeline(candles: DataFrame, slots: DataFrame) -> DataFrame:
    """Full outer join of candles and slots on their timestamp.

    A row is open when it has a closing price. Slots without events score 0.
    """
    joined = candles.join(slots, candles["Datetime"] == slots["DATEADDED"], "full_outer")
    return joined.selectExpr(
        "coalesce(Datetime, DATEADDED) AS master_datetime",
        "CASE WHEN Close IS NOT NULL THEN 1 ELSE 0 END AS market_open",
        *candles.columns,
        *[f"coalesce({c}, 0.0D) AS {c}" for c in [*SCORE_COLUMNS, "event_count"]],
        "coalesce(actor_countries, CAST(array() AS array<string>)) AS actor_countries",
    )


def smooth_periods(assigned: DataFrame, alpha: float = 0.25) -> DataFrame:
    """One row per open timestamp over all timeline rows assigned to it."""
    per_period = assigned.groupBy("target_open_datetime").agg(
        F.count(F.lit(1)).alias("gap_duration_15m"),
        F.sum("event_count").alias("total_event_count"),
        worst_countries().alias("period_actor_countries"),
        *[F.expr(f"sum({c}) AS {c}_sum") for c in SCORE_COLUMNS],
        *[F.expr(f"max({c}) AS {c}_max") for c in SCORE_COLUMNS],
    )
    smoothed = {
        f"{c}_smoothed": F.round(
            hybrid(f"{c}_max", F.expr(f"{c}_sum / gap_duration_15m"), alpha), 6
        )
        for c in SCORE_COLUMNS
    }
    return per_period.withColumns(smoothed)


def open_closed_counts(timeline: DataFrame) -> DataFrame:
    """Rows of the timeline, split into open and closed ones."""
    is_open = F.col("market_open") == 1
    return timeline.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(is_open).alias("open_rows"),
        F.count_if(~is_open).alias("closed_rows"),
    )


def day_slots(days: DataFrame, day: str = "day", step_seconds: int = SLOT_SECONDS) -> DataFrame:
    """Every slot of each listed day, 00:00 to 23:45 for quarter hours."""
    start = F.col(day).cast("timestamp")
    per_day = 86_400 // step_seconds
    offsets = F.sequence(F.lit(0), F.lit(per_day - 1))
    return days.select(day, F.explode(offsets).alias("_i")).select(
        day, F.timestamp_seconds(F.unix_seconds(start) + F.col("_i") * step_seconds).alias("slot")
    )


def missing_slots(landed: DataFrame, days: DataFrame, ts: str, day: str = "day") -> DataFrame:
    """Expected slots of the listed days that did not land."""
    present = landed.select(F.col(ts).alias("slot")).distinct()
    return day_slots(days, day).join(present, "slot", "left_anti")


def slot_completeness(landed: DataFrame, days: DataFrame, ts: str, day: str = "day") -> DataFrame:
    """Expected, present and missing slots per listed day."""
    present = landed.select(F.col(ts).alias("slot")).distinct().withColumn("_here", F.lit(1))
    return (
        day_slots(days, day)
        .join(present, "slot", "left")
        .groupBy(day)
        .agg(
            F.count(F.lit(1)).alias("expected"),
            F.count("_here").alias("present"),
            F.count_if(F.col("_here").isNull()).alias("missing"),
        )
    )
