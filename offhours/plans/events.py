"""Raw events to clean, filtered, scored events."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offhours.functions import geo
from offhours.functions.moments import compact_date, compact_timestamp
from offhours.operators.merge import keep_one, upsert_existing_wins
from offhours.schemas import SILVER_EVENTS, TYPED_EVENTS, conform

# Root codes of the event types taken as major.
MAJOR_ROOT_CODES = (6, 8, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20)

EVENT_KEY = ["GlobalEventID"]


@dataclass(frozen=True)
class EventRules:
    """Thresholds of the major-event filter and the scoring option."""

    since: str | dt.date = "2026-01-01"
    min_articles: int = 4
    min_goldstein: float = 5.0
    min_quad_class: int = 2
    root_codes: tuple[int, ...] = MAJOR_ROOT_CODES
    null_tone: float | None = None

    def __post_init__(self) -> None:
        """``since`` as a date: YYYY, YYYY-M or YYYY-M-D are understood, nothing else."""
        since = self.since
        if not isinstance(since, dt.date):
            found = re.fullmatch(r"(\d{4})(?:-(\d{1,2})(?:-(\d{1,2}))?)?", str(since).strip())
            if not found:
                raise ValueError(f"since is no date: {since!r}")
            since = dt.date(*(int(part or 1) for part in found.groups()))
        elif isinstance(since, dt.datetime):
            since = since.date()
        object.__setattr__(self, "since", since)

    def conditions(self) -> dict[str, Column]:
        """The conditions by name, the cheapest to evaluate first."""
        return {
            "quad_class": F.col("QuadClass") >= self.min_quad_class,
            "root_code": F.col("EventRootCode").isin(*self.root_codes),
            "articles": F.col("NumArticles") >= self.min_articles,
            "goldstein": F.abs("GoldsteinScale") >= self.min_goldstein,
            "since": F.col("Day") >= F.lit(self.since),
        }

    def major(self) -> Column:
        """All conditions; an event that lacks one of the values is not major."""
        return reduce(Column.__and__, self.conditions().values())

    def possible(self) -> Column:
        """Raw rows that may pass the date rule, judged by the text of ``Day``.

        Compact dates sort like the dates they stand for. The comparison reaches
        the Parquet scan, which skips row groups of earlier days unread. Text
        that starts below the digits (a signed year) is left to the exact rule.
        """
        day = F.col("Day")
        return (day >= self.since.strftime("%Y%m%d")) | (day < "0")


def cast_events(raw: DataFrame) -> DataFrame:
    """Keep and type the 23 working columns; text that does not parse turns null."""
    stamped = raw.select(*TYPED_EVENTS.names).withColumns(
        {"DATEADDED": compact_timestamp("DATEADDED"), "Day": compact_date("Day")}
    )
    return conform(stamped, TYPED_EVENTS)


def add_scores(events: DataFrame, null_tone: float | None = None) -> DataFrame:
    """Add importance, buzz, severity, raw score and the countries involved."""
    place, actor1, actor2 = "ActionGeo_CountryCode", "Actor1CountryCode", "Actor2CountryCode"
    i = geo.importance(
        geo.country_weight(actor1),
        geo.country_weight(actor2),
        geo.country_weight(place, geo.FIPS2_WEIGHT),
    )
    b = geo.buzz(F.col("NumArticles").cast("double"))
    s = geo.severity("GoldsteinScale", "AvgTone", null_tone)
    return events.withColumns({"geo_I": i, "geo_B": b, "geo_S": s}).withColumns(
        {
            "geo_score_raw": geo.raw_score(F.col("geo_I"), F.col("geo_B"), F.col("geo_S")),
            "actor_countries": geo.involved_countries(place, actor1, actor2),
        }
    )


def clean_events(
    raw: DataFrame, rules: EventRules = EventRules(), sort: bool = False
) -> DataFrame:
    """Type, filter, de-duplicate and score raw events.

    Of several events with one id any may stay, so the one that passes the
    filter is preferred. That lets the filter run right after the scan: only
    major events are shuffled for the de-duplication, which comes out the same
    as de-duplicating everything first whenever the copies agree.
    """
    major = cast_events(raw.where(rules.possible())).where(rules.major())
    scored = add_scores(keep_one(major, EVENT_KEY), rules.null_tone)
    silver = scored.select(*SILVER_EVENTS.names)
    return silver.orderBy("DATEADDED") if sort else silver


def merge_events(existing: DataFrame, new_clean: DataFrame) -> DataFrame:
    """Existing and new clean events, one per id, existing ones first."""
    return upsert_existing_wins(existing, new_clean, EVENT_KEY)


def daily_events(
    existing: DataFrame, raw_day: DataFrame, rules: EventRules = EventRules()
) -> DataFrame:
    """Clean one landed day and merge it into the existing clean events."""
    return merge_events(existing, clean_events(raw_day, rules))
