"""The three data profiles: candles, events, index. Each is a set of named frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offhours.functions import geo
from offhours.functions.market import candle_direction
from offhours.operators import profile as p
from offhours.plans.events import EventRules
from offhours.schemas import SCORE_COLUMNS

SMOOTHED = [f"{c}_smoothed" for c in SCORE_COLUMNS]

CORRELATED = ["Close", "Variation_Pct", "Volatility_Range", *SMOOTHED]
CORRELATED += ["total_event_count", "score_pct_7d"]

TOP_STRESS = ["Datetime", "Close", "Variation_Pct", "geo_score_raw_smoothed", "score_pct_7d"]
TOP_STRESS += ["total_event_count", "period_actor_country", "gap_duration_15m"]


def candle_shapes(candles: DataFrame, days: int = 10) -> DataFrame:
    """Candlestick values of the last days: direction, body and wick."""
    return p.last_distinct_days(candles, "Datetime", days).select(
        "Datetime",
        candle_direction().alias("direction"),
        (F.col("Close") - F.col("Open")).alias("body"),
        F.col("Low").alias("wick_low"),
        F.col("High").alias("wick_high"),
    )


def volatility_summary(candles: DataFrame) -> DataFrame:
    """Mean, max and min of the rolling volatility of returns."""
    volatility = p.rolling_std(p.returns(candles), "Datetime", "return_pct", out="volatility")
    return volatility.agg(
        F.avg("volatility").alias("mean"),
        F.max("volatility").alias("max"),
        F.min("volatility").alias("min"),
    )


def enrich_events(events: DataFrame) -> DataFrame:
    """Add the exploratory buzz and weighted gravity."""
    return events.withColumns(
        {
            "buzz": geo.buzz(F.col("NumArticles").cast("double")),
            "weighted_gravity": geo.weighted_gravity("GoldsteinScale", "AvgTone"),
        }
    )


def event_funnel(events: DataFrame, rules: EventRules = EventRules()) -> DataFrame:
    """Effect of each filter, each pair, and all of them.

    "all filters" leaves the root codes out, as analysts are used to; "all with
    root codes" is the filter that the pipeline applies, but for the date.
    """
    named = rules.conditions()
    root, articles, goldstein, quad = "root_code", "articles", "goldstein", "quad_class"
    predicates = {k: F.coalesce(named[k], F.lit(False)) for k in (root, articles, goldstein, quad)}
    members = list(predicates)
    pairs = {
        f"{a} + {b}": [a, b] for i, a in enumerate(members) for b in members[i + 1 :]
    }
    everything = {
        "all filters": [articles, goldstein, quad],
        "all with root codes": members,
    }
    return p.filter_funnel(events, predicates, {**pairs, **everything})


def quad_class_counts(events: DataFrame, size: int = 10) -> DataFrame:
    """Most frequent event classes by label."""
    counts = p.value_counts(events, "QuadClass", size)
    return counts.select(geo.quad_label("QuadClass").alias("label"), "n")


def actor_events(events: DataFrame, code: str) -> DataFrame:
    """Events in which either actor has the given code."""
    return events.where((F.col("Actor1Code") == code) | (F.col("Actor2Code") == code))


def top_stress(gold: DataFrame, size: int = 20) -> DataFrame:
    """The candles with the highest smoothed score, one row each."""
    unique = p.one_per(gold.select(*TOP_STRESS), "Datetime", ["period_actor_country"])
    ranked = p.top_rows(unique, "geo_score_raw_smoothed", size, ["Datetime"])
    return ranked.select(*TOP_STRESS)


def profile_candles(candles: DataFrame) -> dict[str, DataFrame]:
    """Everything there is to know about a candle series.

    Duplicates are counted on the rows as given. The ordered parts expect one
    row per timestamp, so de-duplicate raw candles for those.
    """
    with_returns = p.returns(candles)
    return {
        "describe": p.describe(candles),
        "time_range": p.time_range(candles, "Datetime"),
        "close": p.column_stats(candles, "Close"),
        "nulls": p.null_profile(candles),
        "duplicates": p.duplicate_counts(candles, ["Datetime"]),
        "intervals": p.interval_profile(candles, "Datetime"),
        "per_day": p.rows_per_day(candles, "Datetime"),
        "per_day_summary": p.per_day_summary(candles, "Datetime"),
        "per_hour": p.rows_per_hour(candles, "Datetime"),
        "moving_average": p.rolling_mean(candles, "Datetime", "Close"),
        "candlesticks": candle_shapes(candles),
        "volume": p.totals(candles, "Volume"),
        "close_histogram": p.histogram(candles, "Close", 50),
        "return_histogram": p.histogram(with_returns, "return_pct", 80),
        "returns": p.column_stats(with_returns, "return_pct"),
        "volatility": volatility_summary(candles),
        "head": p.head(candles, ["Datetime"]),
        "tail": p.tail(candles, ["Datetime"]),
    }


def profile_events(events: DataFrame, rules: EventRules = EventRules()) -> dict[str, DataFrame]:
    """Profile of typed events, before or after the filter."""
    return {
        "nulls": p.null_profile(events),
        "duplicates": p.duplicate_counts(events, ["GlobalEventID"]),
        "time_range": p.time_range(events, "DATEADDED"),
        "describe": p.describe(events),
        "per_day": p.rows_per_day(events, "Day"),
        "goldstein_histogram": p.histogram(events, "GoldsteinScale", 50),
        "tone_histogram": p.histogram(events, "AvgTone", 50),
        "quad_classes": quad_class_counts(events),
        "actor1_countries": p.value_counts(events, "Actor1CountryCode", 20),
        "actor2_countries": p.value_counts(events, "Actor2CountryCode", 20),
        "places": p.value_counts(events, "ActionGeo_CountryCode", 20),
        "enriched": enrich_events(events.where(rules.major())),
        "funnel": event_funnel(events, rules),
    }


def profile_gold(gold: DataFrame) -> dict[str, DataFrame]:
    """Profile of the index table."""
    return {
        "rows": p.distinct_ratio(gold, "Datetime"),
        "nulls": p.null_profile(gold),
        "duplicates": p.duplicate_counts(gold, ["Datetime"]),
        "describe": p.describe(gold),
        "largest_change": p.top_rows(gold, "Variation_Pct", 1, ["Datetime", "period_actor_country"]),
        **{f"{c}_histogram": p.histogram(gold, c, 50) for c in SMOOTHED},
        "gap_histogram": p.histogram(gold, "gap_duration_15m", 50),
        "correlation": p.correlation_matrix(gold, CORRELATED),
        "countries": p.value_counts(gold, "period_actor_country", 15),
        "top_stress": top_stress(gold),
        "diagnostics": p.score_diagnostics(gold, [*SMOOTHED, "total_event_count"]),
    }
