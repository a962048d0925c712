"""Every registered query: the Spark callable and, where SQL can say it, its SQL.

All of them start from the given ``events`` table, from which the two raw feeds
are derived, and run over all of it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.sql import (
    ACTOR1_ISO3,
    ACTOR2_ISO3,
    MAJOR,
    PLACE_ISO3,
    ROOTS,
    SCORES,
    W1,
    W3,
    case,
    with_layers,
)
from offhours.functions import geo
from offhours.operators import merge, ordered, profile, slots
from offhours.plans import calibration, candles, events, gold, profiles, serving
from offhours.plans.landing import day_report
from offhours.schemas import GOLD, SILVER_CANDLES, SILVER_EVENTS, TYPED_EVENTS
from offhours.session import fresh_folder, materialize, prepare
from offhours.sources import documents, exports, feed, lake
from offhours.streaming import landed

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

RULES = events.EventRules(since=feed.FEED_START)
DAY = "2024-01-26"
SMOOTHED = profiles.SMOOTHED


class Layers:
    """The layers of the pipeline over one data directory, built on demand.

    Clean candles are a stored table in practice, and read several times. Here
    they are checkpointed once, so that no query derives them again from the
    activity table for each use.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.activity = spark.read.parquet(f"{sf_dir}/events.parquet")

    @property
    def raw_events(self) -> DataFrame:
        return feed.raw_events(self.activity)

    @property
    def typed_events(self) -> DataFrame:
        return events.cast_events(self.raw_events)

    @property
    def events(self) -> DataFrame:
        return events.clean_events(self.raw_events, RULES)

    @property
    def raw_candles(self) -> DataFrame:
        return feed.raw_candles(self.activity)

    @property
    def typed_candles(self) -> DataFrame:
        return candles.cast_candles(self.raw_candles)

    @cached_property
    def candles(self) -> DataFrame:
        return materialize(candles.clean_candles(self.raw_candles))

    @property
    def slots(self) -> DataFrame:
        return slots.slot_scores(self.events)

    @property
    def assigned(self) -> DataFrame:
        return gold.assign_periods(self.candles, self.slots)

    @property
    def candle_gold(self) -> DataFrame:
        return gold.candle_scores(self.candles, self.events)

    @property
    def gold(self) -> DataFrame:
        return gold.stress_index(self.candles, self.events)

    @cached_property
    def stored_gold(self) -> DataFrame:
        """The index as a stored table, for queries that read it more than once."""
        return materialize(self.gold)


def tidy(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Timestamps without zone, dates and lists as text, doubles rounded if asked."""

    def column(f: T.StructField) -> str:
        c = f"`{f.name}`"
        if isinstance(f.dataType, T.TimestampType):
            return f"CAST({c} AS timestamp_ntz) AS {c}"
        if isinstance(f.dataType, T.DateType):
            return f"CAST({c} AS string) AS {c}"
        if isinstance(f.dataType, T.ArrayType):
            return f"concat_ws('|', {c}) AS {c}"
        if isinstance(f.dataType, T.DoubleType) and digits is not None:
            return f"round({c}, {digits}) AS {c}"
        return c

    return df.selectExpr(*[column(f) for f in df.schema])


def query(name: str, sql: str | None = None, extra: str = "", digits: int | None = None):
    def register(build: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: tidy(build(Layers(spark, sf_dir)), digits)
        if sql is not None:
            SQL[name] = with_layers(sql, extra)
        return build

    return register


def joined(column: str) -> str:
    return f"array_to_string({column}, '|') AS {column}"


def rounded(columns: list[str], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


TYPED_SQL = ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" if c == "Day" else c for c in TYPED_EVENTS.names
)
ROUNDED_SQL = TYPED_SQL.replace("AvgTone", "round(AvgTone, 6) AS AvgTone").replace(
    "GoldsteinScale", "round(GoldsteinScale, 6) AS GoldsteinScale"
)
SILVER_SQL = f"{ROUNDED_SQL}, {rounded(SCORES)}, {joined('actor_countries')}"
GOLD_ROUND = [f"{c}_sum" for c in SCORES] + [f"{c}_smoothed" for c in SCORES]
GOLD_ROUND += ["geo_score_raw_max"]
GOLD_SQL = "SELECT " + ", ".join(
    f"round({c}, 6) AS {c}" if c in GOLD_ROUND else c for c in GOLD.names
)
CANDLE_SQL = ", ".join(SILVER_CANDLES.names)


# --- events ---------------------------------------------------------------------------


@query("event_cast", f"SELECT {TYPED_SQL} FROM typed_events")
def _(layers):
    return layers.typed_events


@query("event_major_filter", f"SELECT {TYPED_SQL} FROM typed_events WHERE {MAJOR}")
def _(layers):
    return layers.typed_events.where(RULES.major())


@query("event_dedup", f"SELECT {TYPED_SQL} FROM base_events")
def _(layers):
    return merge.keep_one(layers.typed_events, events.EVENT_KEY)


@query(
    "country_weight",
    f"""SELECT ActionGeo_CountryCode AS place, Actor1CountryCode AS actor,
               {W3} AS place_weight, {W1} AS actor_weight, count(*) AS n
        FROM typed_events GROUP BY 1, 2, 3, 4""",
)
def _(layers):
    place, actor = F.col("ActionGeo_CountryCode"), F.col("Actor1CountryCode")
    return layers.typed_events.groupBy(
        place.alias("place"),
        actor.alias("actor"),
        geo.country_weight(place, geo.FIPS2_WEIGHT).alias("place_weight"),
        geo.country_weight(actor).alias("actor_weight"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "country_iso3",
    f"""SELECT GlobalEventID, {PLACE_ISO3} AS place, {ACTOR1_ISO3} AS actor1,
               {ACTOR2_ISO3} AS actor2 FROM base_events""",
)
def _(layers):
    unique = merge.keep_one(layers.typed_events, events.EVENT_KEY)
    return unique.select(
        "GlobalEventID",
        geo.iso3("ActionGeo_CountryCode", False).alias("place"),
        geo.iso3("Actor1CountryCode", True).alias("actor1"),
        geo.iso3("Actor2CountryCode", True).alias("actor2"),
    )


@query(
    "clip01",
    """SELECT GlobalEventID, greatest(0.0, least(1.0, -GoldsteinScale / 10.0)) AS conflict,
              greatest(0.0, least(1.0, -AvgTone / 100.0)) AS hostility FROM typed_events""",
)
def _(layers):
    return layers.typed_events.select(
        "GlobalEventID",
        geo.clip01(-F.col("GoldsteinScale") / 10.0).alias("conflict"),
        geo.clip01(-F.col("AvgTone") / 100.0).alias("hostility"),
    )


@query("geo_scores", f"SELECT GlobalEventID, {rounded(SCORES)} FROM silver_events", digits=6)
def _(layers):
    return layers.events.select("GlobalEventID", *SCORES)


@query("actor_countries", f"SELECT GlobalEventID, {joined('actor_countries')} FROM silver_events")
def _(layers):
    return layers.events.select("GlobalEventID", "actor_countries")


@query("events_clean", f"SELECT {SILVER_SQL} FROM silver_events", digits=6)
def _(layers):
    return events.clean_events(layers.raw_events, RULES, sort=True)


# --- candles --------------------------------------------------------------------------


@query("candle_cast", "SELECT Datetime, Open, High, Low, Close, Volume FROM typed_candles")
def _(layers):
    return layers.typed_candles


@query("candle_dedup", "SELECT * FROM unique_candles")
def _(layers):
    return merge.keep_one(layers.typed_candles, candles.CANDLE_KEY)


@query("candle_range", "SELECT Datetime, Volatility_Range FROM silver_candles")
def _(layers):
    unique = merge.keep_one(layers.typed_candles, candles.CANDLE_KEY)
    return candles.add_range(unique).select("Datetime", "Volatility_Range")


@query("candle_variation", "SELECT Datetime, Close, Variation_Pct FROM silver_candles")
def _(layers):
    unique = merge.keep_one(layers.typed_candles, candles.CANDLE_KEY)
    return candles.add_variation(unique).select("Datetime", "Close", "Variation_Pct")


@query("candles_clean", f"SELECT {CANDLE_SQL} FROM silver_candles")
def _(layers):
    return candles.clean_candles(layers.raw_candles, sort=True)


@query(
    "flat_header",
    "SELECT Datetime, Open, High, Low, Close, Volume FROM typed_candles",
)
def _(layers):
    two_level = layers.raw_candles.select(
        "Datetime",
        *[F.struct(F.col(c).alias("TICKER")).alias(c) for c in ("Open", "High", "Low")],
        F.col("Close").alias("('Close', 'TICKER')"),
        F.col("Volume").alias("('Volume', 'TICKER')"),
    )
    return candles.cast_candles(candles.flatten_header(two_level))


# --- slots, timeline, index -----------------------------------------------------------


@query(
    "slot_aggregate",
    f"SELECT DATEADDED, {rounded(SCORES)}, event_count FROM slots",
    digits=6,
)
def _(layers):
    return layers.slots.drop("actor_countries")


@query("slot_worst_actor", f"SELECT DATEADDED, {joined('actor_countries')} FROM slots")
def _(layers):
    return layers.slots.select("DATEADDED", "actor_countries")


@query(
    "timeline_full_join",
    f"""SELECT master_datetime, market_open, Datetime, Close, {rounded(SCORES)}, event_count,
               {joined('actor_countries')} FROM timeline""",
    digits=6,
)
def _(layers):
    timeline = slots.join_timeline(layers.candles, layers.slots)
    return timeline.select(
        "master_datetime", "market_open", "Datetime", "Close", *SCORES, "event_count",
        "actor_countries",
    )


@query(
    "open_closed_counts",
    """SELECT count(*) AS "rows", count(*) FILTER (market_open = 1) AS open_rows,
              count(*) FILTER (market_open = 0) AS closed_rows FROM timeline""",
)
def _(layers):
    return slots.open_closed_counts(slots.join_timeline(layers.candles, layers.slots))


@query("next_open", "SELECT master_datetime, market_open, target_open_datetime FROM assigned")
def _(layers):
    return layers.assigned.select("master_datetime", "market_open", "target_open_datetime")


PERIOD_SUMS = ", ".join(f"{c}_{k}" for c in SCORES for k in ("sum", "max", "smoothed"))


@query(
    "smooth_periods",
    f"""SELECT target_open_datetime, gap_duration_15m, total_event_count,
               {joined('period_actor_countries')}, {rounded(PERIOD_SUMS.split(', '))}
        FROM periods""",
    digits=6,
)
def _(layers):
    return slots.smooth_periods(layers.assigned)


@query(
    "gold_inner_join",
    f"""SELECT {CANDLE_SQL}, gap_duration_15m, total_event_count,
               round(geo_score_raw_smoothed, 6) AS geo_score_raw_smoothed FROM candle_periods""",
)
def _(layers):
    joined_ = gold.join_periods(layers.candles, slots.smooth_periods(layers.assigned))
    return joined_.select(
        *SILVER_CANDLES.names, "gap_duration_15m", "total_event_count", "geo_score_raw_smoothed"
    )


@query(
    "rolling_minmax_score",
    """SELECT Datetime, round(geo_score_raw_smoothed, 6) AS geo_score_raw_smoothed, score_pct_7d
       FROM candle_gold""",
)
def _(layers):
    joined_ = gold.join_periods(layers.candles, slots.smooth_periods(layers.assigned))
    scores = materialize(joined_.select("Datetime", "geo_score_raw_smoothed"))
    placed = ordered.with_position(scores, "Datetime", "_position")
    return gold.rolling_score(placed, "_position").drop("_position")


@query("explode_countries", "SELECT Datetime, period_actor_country FROM gold")
def _(layers):
    return gold.explode_countries(
        layers.candle_gold.select("Datetime", "period_actor_countries")
    )


@query("gold_history", f"{GOLD_SQL} FROM gold", digits=6)
def _(layers):
    return layers.gold


# --- incremental ----------------------------------------------------------------------

OLD, LATE = "20240120", "20240115"


@query(
    "upsert_existing_wins",
    f"""SELECT {ROUNDED_SQL.replace('NumMentions', 'CAST(NumMentions + CASE WHEN Day >= '
        "DATE '2024-01-20' THEN 1000 ELSE 0 END AS INTEGER) AS NumMentions")},
        {rounded(SCORES)}, {joined('actor_countries')} FROM silver_events""",
    digits=6,
)
def _(layers):
    raw = layers.raw_events
    existing = events.clean_events(raw.where(F.col("Day") < OLD), RULES)
    again = raw.where(F.col("Day") >= LATE).withColumn(
        "NumMentions", (F.col("NumMentions").cast("int") + 1000).cast("string")
    )
    return events.daily_events(existing, again, RULES)


@query("new_events_only", "SELECT GlobalEventID FROM silver_events WHERE Day >= DATE '2024-01-20'")
def _(layers):
    raw = layers.raw_events
    existing = events.clean_events(raw.where(F.col("Day") < OLD), RULES)
    landed = events.clean_events(raw.where(F.col("Day") >= LATE), RULES)
    return merge.new_only(existing, landed, events.EVENT_KEY).select("GlobalEventID")


@query("candles_daily", f"SELECT {CANDLE_SQL} FROM silver_candles")
def _(layers):
    raw, split = layers.raw_candles, "2024-01-20"
    existing = candles.clean_candles(raw.where(F.col("Datetime") < split))
    return candles.merge_candles(existing, raw.where(F.col("Datetime") >= "2024-01-15"))


@query("gold_daily", f"{GOLD_SQL} FROM gold", digits=6)
def _(layers):
    stale = layers.gold.withColumn(
        "score_pct_7d",
        F.when(F.to_date("Datetime") == DAY, F.lit(-1.0)).otherwise(F.col("score_pct_7d")),
    )
    return gold.daily_index(stale, layers.candles, layers.events, DAY)


@query(
    "replace_day",
    f"""SELECT Datetime, Close, CASE WHEN CAST(Datetime AS DATE) = DATE '{DAY}'
               THEN 'fresh' END AS note FROM silver_candles""",
)
def _(layers):
    existing = layers.candles.select("Datetime", "Close")
    fresh = existing.where(F.to_date("Datetime") == DAY).withColumn("note", F.lit("fresh"))
    return merge.replace_day(existing, fresh, "Datetime", DAY)


@query(
    "context_window_scan",
    f"""SELECT GlobalEventID, DATEADDED FROM silver_events
        WHERE DATEADDED >= DATE '{DAY}' - INTERVAL 8 DAY
          AND DATEADDED < DATE '{DAY}' + INTERVAL 1 DAY""",
)
def _(layers):
    window = merge.days_around(layers.events, "DATEADDED", DAY, 8)
    return window.select("GlobalEventID", "DATEADDED")


@query(
    "day_sink",
    "SELECT CAST(CAST(Datetime AS DATE) AS VARCHAR) AS day, count(*) AS n FROM silver_candles GROUP BY 1",
)
def _(layers):
    path = fresh_folder(layers.spark, "day-sink")
    lake.write_days(layers.candles, path, "Datetime")
    lake.write_days(layers.candles, path, "Datetime")  # a second run changes nothing
    return profile.rows_per_day(lake.read_table(layers.spark, path, SILVER_CANDLES), "Datetime")


@query("recursive_scan", f"SELECT {CANDLE_SQL} FROM silver_candles")
def _(layers):
    path = fresh_folder(layers.spark, "folders")
    lake.write_days(layers.candles, path, "Datetime")
    return lake.read_folders(layers.spark, path, SILVER_CANDLES)


# --- serving --------------------------------------------------------------------------

FLOATS = [f for f in GOLD.names if f not in ("Datetime", "Volume", "gap_duration_15m")]
FLOATS = [f for f in FLOATS if f not in ("period_actor_country", "geo_score_raw_max")]
DOCUMENT_SQL = f"""SELECT strftime(Datetime, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp", Volume,
    {', '.join(f'round(CAST({c} AS FLOAT)::DOUBLE, 2) AS {c}' for c in FLOATS)},
    CAST(gap_duration_15m AS INTEGER) AS gap_duration_15m, period_actor_country,
    sha256(strftime(Datetime, '%Y-%m-%dT%H:%M:%SZ') || '|' || coalesce(period_actor_country, ''))
      AS "_id"
  FROM gold"""


@query("serve_documents", DOCUMENT_SQL)
def _(layers):
    typed = serving.with_document_id(serving.to_documents(layers.gold))
    return typed.withColumns({c: F.round(F.col(c).cast("double"), 2) for c in FLOATS})


@query(
    "serve_json",
    """SELECT strftime(Datetime, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp", Volume,
              CAST(gap_duration_15m AS INTEGER) AS gap_duration_15m, period_actor_country
       FROM gold""",
)
def _(layers):
    lines = serving.as_json(serving.to_documents(layers.gold))
    schema = "timestamp string, Volume bigint, gap_duration_15m int, period_actor_country string"
    return lines.select(F.from_json("_source", schema).alias("d")).select("d.*")


@query("write_accounting", "SELECT count(*) AS success, CAST(0 AS BIGINT) AS errors FROM gold")
def _(layers):
    return documents.accounts(layers.gold)


DASHBOARD = ["Close", "geo_I_smoothed", "geo_B_smoothed", "geo_S_smoothed"]


@query(
    "hist_avg_15m",
    f"""SELECT time_bucket(INTERVAL '15 minutes', Datetime) AS bucket,
               {', '.join(f'round(avg({c}), 6) AS {c}' for c in DASHBOARD)} FROM gold GROUP BY 1""",
    digits=6,
)
def _(layers):
    return serving.average_over_time(layers.gold, DASHBOARD)


@query(
    "hist_dual_axis",
    """SELECT time_bucket(INTERVAL '15 minutes', Datetime) AS bucket,
              round(avg(Variation_Pct), 6) AS Variation_Pct,
              round(avg(geo_score_raw_smoothed), 6) AS geo_score_raw_smoothed
       FROM gold GROUP BY 1""",
    digits=6,
)
def _(layers):
    return serving.average_over_time(layers.gold, ["Variation_Pct", "geo_score_raw_smoothed"])


AUTO_SQL = """
span AS (SELECT CAST(epoch(min(Datetime)) AS BIGINT) AS a, CAST(epoch(max(Datetime)) AS BIGINT) AS b
         FROM candle_gold),
width AS (SELECT coalesce((SELECT min(w) FROM unnest([900, 3600, 10800, 43200, 86400]) AS t(w)
                           WHERE b // w - a // w + 1 <= 100), 86400) AS w FROM span)"""


@query(
    "hist_avg_auto",
    """SELECT make_timestamp((CAST(epoch(Datetime) AS BIGINT) // w) * w * 1000000) AS bucket,
              CAST(w AS INTEGER) AS interval_seconds, round(avg(Volume), 6) AS Volume
       FROM candle_gold, width GROUP BY 1, 2""",
    extra=AUTO_SQL,
    digits=6,
)
def _(layers):
    volumes = serving.one_per_candle(layers.stored_gold, ["Volume"])
    return serving.average_auto(volumes, ["Volume"])


@query(
    "top_actors",
    """SELECT period_actor_country, count(*) AS n FROM gold WHERE period_actor_country IS NOT NULL
       GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10""",
)
def _(layers):
    return serving.top_terms(layers.gold, "period_actor_country")


@query(
    "country_map",
    f"""SELECT iso3, n FROM unnest([{', '.join(f"'{c}'" for c in geo.ISO3_WEIGHT)}]) AS t(iso3)
        LEFT JOIN (SELECT period_actor_country, count(*) AS n FROM gold GROUP BY 1)
          ON iso3 = period_actor_country""",
)
def _(layers):
    codes = layers.spark.createDataFrame([(c,) for c in geo.ISO3_WEIGHT], "iso3 string")
    return serving.country_counts(codes, layers.gold)


FILL_SQL = """
known AS (SELECT Datetime AS bucket, Close FROM candle_gold),
spine AS (SELECT unnest(generate_series((SELECT min(bucket) FROM known),
                                        (SELECT max(bucket) FROM known),
                                        INTERVAL '15 minutes')) AS bucket),
neighbours AS (
  SELECT s.bucket, k.Close,
         last_value(k.Close IGNORE NULLS) OVER b AS pv, first_value(k.Close IGNORE NULLS) OVER f AS nv,
         max(k.bucket) OVER b AS pt, min(k.bucket) OVER f AS nt
  FROM spine s LEFT JOIN known k USING (bucket)
  WINDOW b AS (ORDER BY s.bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         f AS (ORDER BY s.bucket ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query(
    "hist_filled",
    "SELECT bucket, round(Close, 6) AS Close, Close IS NULL AS filled FROM neighbours",
    extra=FILL_SQL,
    digits=6,
)
def _(layers):
    per_bucket = serving.average_over_time(layers.stored_gold, ["Close"])
    return serving.fill_empty_buckets(per_bucket, ["Close"])


@query(
    "hist_interpolated",
    """SELECT 'Close' AS field, bucket, Close IS NULL AS filled,
              round(CASE WHEN Close IS NOT NULL THEN Close
                    ELSE pv + (nv - pv) * ((epoch(bucket) - epoch(pt)) / (epoch(nt) - epoch(pt)))
                    END, 9) AS value
       FROM neighbours""",
    extra=FILL_SQL,
    digits=9,
)
def _(layers):
    per_bucket = serving.average_over_time(layers.stored_gold, ["Close"])
    return serving.fill_series(per_bucket, ["Close"])


@query(
    "last_90d",
    """SELECT Datetime, Close, period_actor_country FROM gold
       WHERE Datetime BETWEEN TIMESTAMP '2024-04-10' - INTERVAL 90 DAY AND TIMESTAMP '2024-04-10'""",
)
def _(layers):
    recent = serving.last_days(layers.gold, "Datetime", 90, "2024-04-10")
    return recent.select("Datetime", "Close", "period_actor_country")


# --- profiles -------------------------------------------------------------------------

NUMBERS = ["Open", "High", "Low", "Close", "Volume"]


def describe_sql(columns: list[str], source: str, digits: int) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), {digits}) AS mean,
            round(stddev_samp({c}), {digits}) AS std, round(min({c})::DOUBLE, {digits}) AS min,
            round(quantile_cont({c}::DOUBLE, 0.25), {digits}) AS p25,
            round(quantile_cont({c}::DOUBLE, 0.5), {digits}) AS p50,
            round(quantile_cont({c}::DOUBLE, 0.75), {digits}) AS p75,
            round(max({c})::DOUBLE, {digits}) AS max FROM {source}"""
        for c in columns
    )


@query("describe", describe_sql(NUMBERS, "unique_candles", 6), digits=6)
def _(layers):
    return profile.describe(layers.candles, NUMBERS)


EVENT_NUMBERS = ["GoldsteinScale", "AvgTone", "NumArticles", "NumMentions", "ActionGeo_Lat"]


@query("describe_events", describe_sql(EVENT_NUMBERS, "typed_events", 6), digits=6)
def _(layers):
    return profile.describe(layers.typed_events, EVENT_NUMBERS)


@query(
    "column_stats",
    """SELECT min(Close) AS min, max(Close) AS max, round(avg(Close), 6) AS mean,
              round(stddev_samp(Close), 6) AS std, round(max(Close) - min(Close), 6) AS "range",
              round(quantile_cont(Close, 0.5), 6) AS median FROM silver_candles""",
    digits=6,
)
def _(layers):
    return profile.column_stats(layers.candles, "Close")


@query(
    "time_range", "SELECT min(DATEADDED) AS first, max(DATEADDED) AS last FROM silver_events"
)
def _(layers):
    return profile.time_range(layers.events, "DATEADDED")


NULLED = ["Actor1CountryCode", "Actor2CountryCode", "ActionGeo_CountryCode", "AvgTone"]


@query(
    "null_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing,
            (SELECT round(({' + '.join(f'count(*) - count({x})' for x in NULLED)}) * 100.0
                          / (count(*) * {len(NULLED)}), 2) FROM typed_events) AS total_missing_pct
            FROM typed_events"""
        for c in NULLED
    ),
)
def _(layers):
    return profile.null_profile(layers.typed_events.select(*NULLED))


@query(
    "dup_profile",
    """SELECT (SELECT count(*) FROM typed_events) AS "rows",
              (SELECT count(*) FROM typed_events)
                - (SELECT count(*) FROM (SELECT DISTINCT * FROM typed_events)) AS duplicate_rows,
              (SELECT count(*) - count(DISTINCT GlobalEventID) FROM typed_events)
                AS duplicate_keys""",
)
def _(layers):
    return profile.duplicate_counts(layers.typed_events, ["GlobalEventID"])


@query(
    "candle_dup_profile",
    """SELECT (SELECT count(*) FROM typed_candles) AS "rows",
              CAST(0 AS BIGINT) AS duplicate_rows,
              (SELECT count(*) - count(DISTINCT Datetime) FROM typed_candles) AS duplicate_keys""",
)
def _(layers):
    return profile.duplicate_counts(layers.typed_candles, ["Datetime"])


@query(
    "distinct_ratio",
    """SELECT count(*) AS "rows", count(DISTINCT Datetime) AS timestamps,
              count(DISTINCT CAST(Datetime AS DATE)) AS days,
              round(count(*) / count(DISTINCT Datetime), 2) AS rows_per_timestamp FROM gold""",
)
def _(layers):
    return profile.distinct_ratio(layers.gold, "Datetime")


@query("per_day", "SELECT CAST(Day AS VARCHAR) AS day, count(*) AS n FROM typed_events GROUP BY 1")
def _(layers):
    return profile.rows_per_day(layers.typed_events, "Day")


@query(
    "per_day_summary",
    """SELECT count(*) AS days, round(avg(n), 6) AS mean_per_day FROM (
         SELECT CAST(Datetime AS DATE), count(*) AS n FROM silver_candles GROUP BY 1)""",
    digits=6,
)
def _(layers):
    return profile.per_day_summary(layers.candles, "Datetime")


@query(
    "per_hour",
    "SELECT CAST(hour(Datetime) AS INTEGER) AS hour, count(*) AS n FROM silver_candles GROUP BY 1",
)
def _(layers):
    return profile.rows_per_hour(layers.candles, "Datetime")


@query(
    "volume_totals",
    """SELECT CAST(sum(Volume) AS BIGINT) AS total, round(avg(Volume), 6) AS mean
       FROM silver_candles""",
    digits=6,
)
def _(layers):
    return profile.totals(layers.candles, "Volume")


def histogram_sql(column: str, source: str, bins: int) -> str:
    return f"""
      SELECT CAST(s.bin AS INTEGER) AS bin, round(lo + s.bin * w, 6) AS low,
             round(lo + (s.bin + 1) * w, 6) AS high, coalesce(n, 0) AS n
      FROM (SELECT unnest(range({bins})) AS bin) s
      CROSS JOIN (SELECT min({column})::DOUBLE AS lo,
                         (max({column})::DOUBLE - min({column})::DOUBLE) / {bins} AS w FROM {source})
      LEFT JOIN (
        SELECT least(floor(({column}::DOUBLE - lo) / w), {bins - 1}) AS bin, count(*) AS n
        FROM {source}, (SELECT min({column})::DOUBLE AS lo,
               (max({column})::DOUBLE - min({column})::DOUBLE) / {bins} AS w FROM {source})
        WHERE {column} IS NOT NULL GROUP BY 1) c ON c.bin = s.bin"""


@query("histogram", histogram_sql("GoldsteinScale", "typed_events", 50), digits=6)
def _(layers):
    return profile.histogram(layers.typed_events, "GoldsteinScale", 50)


RETURNS_SQL = """
returns AS (SELECT Datetime, (Close - lag(Close) OVER w) / nullif(lag(Close) OVER w, 0) * 100
                    AS return_pct
            FROM silver_candles WINDOW w AS (ORDER BY Datetime))"""


@query(
    "return_histogram", histogram_sql("return_pct", "returns", 80), extra=RETURNS_SQL, digits=6
)
def _(layers):
    return profile.histogram(profile.returns(layers.candles), "return_pct", 80)


@query(
    "return_stats",
    """SELECT round(min(return_pct), 6) AS min, round(max(return_pct), 6) AS max,
              round(avg(return_pct), 6) AS mean, round(stddev_samp(return_pct), 6) AS std,
              round(max(return_pct) - min(return_pct), 6) AS "range",
              round(quantile_cont(return_pct, 0.5), 6) AS median FROM returns""",
    extra=RETURNS_SQL,
    digits=6,
)
def _(layers):
    return profile.column_stats(profile.returns(layers.candles), "return_pct")


@query(
    "value_counts",
    """SELECT Actor1CountryCode, count(*) AS n FROM typed_events
       WHERE Actor1CountryCode IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20""",
)
def _(layers):
    return profile.value_counts(layers.typed_events, "Actor1CountryCode", 20)


@query(
    "quad_class_counts",
    f"""SELECT {case('QuadClass', geo.QUAD_LABELS)}
               AS label, count(*) AS n FROM typed_events GROUP BY 1""",
)
def _(layers):
    return profiles.quad_class_counts(layers.typed_events)


CORRELATED = profiles.CORRELATED


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 3) AS r FROM gold"
        for a in CORRELATED
        for b in CORRELATED
    ),
)
def _(layers):
    return profile.correlation_matrix(layers.gold, CORRELATED)


@query(
    "interval_profile",
    """SELECT CAST((SELECT g FROM gaps WHERE g IS NOT NULL GROUP BY g
                    ORDER BY count(*) DESC, g LIMIT 1) AS BIGINT) AS most_frequent,
              CAST(min(g) AS BIGINT) AS shortest, CAST(max(g) AS BIGINT) AS longest FROM gaps""",
    extra="""
gaps AS (SELECT epoch(Datetime) - epoch(lag(Datetime) OVER (ORDER BY Datetime)) AS g
         FROM silver_candles)""",
)
def _(layers):
    return profile.interval_profile(layers.candles, "Datetime")


DIAGNOSED = [*SMOOTHED, "total_event_count"]


@query(
    "score_diagnostics",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS score, round(min({c}), 6) AS min, round(max({c}), 6) AS max,
            round(avg({c}), 6) AS mean, count(*) FILTER ({c} <> 0) AS non_zero,
            count(*) FILTER ({c} = 0) AS zero, count(*) AS "rows" FROM gold"""
        for c in DIAGNOSED
    ),
    digits=6,
)
def _(layers):
    return profile.score_diagnostics(layers.gold, DIAGNOSED)


def funnel_sql() -> str:
    p = {
        "root_code": f"EventRootCode IN ({ROOTS})",
        "articles": "NumArticles >= 4",
        "goldstein": "abs(GoldsteinScale) >= 5",
        "quad_class": "QuadClass >= 2",
    }
    names = list(p)
    steps = {"all rows": "true", **p}
    steps |= {
        f"{a} + {b}": f"{p[a]} AND {p[b]}" for i, a in enumerate(names) for b in names[i + 1 :]
    }
    steps["all filters"] = " AND ".join(p[n] for n in names[1:])
    steps["all with root codes"] = " AND ".join(p.values())
    return " UNION ALL ".join(
        f"""SELECT CAST({i} AS INTEGER) AS step, '{name}' AS filter,
            count(*) FILTER ({test}) AS n,
            round(count(*) FILTER ({test}) * 100.0 / count(*), 2) AS kept_pct,
            count(*) - count(*) FILTER ({test}) AS removed,
            round((count(*) - count(*) FILTER ({test})) * 100.0 / count(*), 2) AS removed_pct
            FROM typed_events"""
        for i, (name, test) in enumerate(steps.items())
    )


@query("filter_funnel", funnel_sql())
def _(layers):
    return profiles.event_funnel(layers.typed_events, RULES)


@query(
    "rolling_mean",
    """SELECT Datetime, round(avg(Close) OVER (ORDER BY Datetime
              ROWS BETWEEN 95 PRECEDING AND CURRENT ROW), 9) AS rolling_mean FROM silver_candles""",
    digits=9,
)
def _(layers):
    means = profile.rolling_mean(layers.candles, "Datetime", "Close")
    return means.select("Datetime", "rolling_mean")


VOLATILITY_SQL = (
    RETURNS_SQL
    + """,
volatility AS (
  SELECT Datetime, CASE WHEN count(return_pct) OVER w >= 20 THEN stddev_samp(return_pct) OVER w END
         AS volatility
  FROM returns WINDOW w AS (ORDER BY Datetime ROWS BETWEEN 95 PRECEDING AND CURRENT ROW))"""
)


@query(
    "rolling_std",
    "SELECT Datetime, round(volatility, 6) AS volatility FROM volatility",
    extra=VOLATILITY_SQL,
    digits=6,
)
def _(layers):
    spread = profile.rolling_std(
        profile.returns(layers.candles), "Datetime", "return_pct", out="volatility"
    )
    return spread.select("Datetime", "volatility")


@query(
    "volatility_summary",
    """SELECT round(avg(volatility), 6) AS mean, round(max(volatility), 6) AS max,
              round(min(volatility), 6) AS min FROM volatility""",
    extra=VOLATILITY_SQL,
    digits=6,
)
def _(layers):
    return profiles.volatility_summary(layers.candles)


@query(
    "alt_severity",
    """SELECT GlobalEventID, round(ln(1.0 + NumArticles), 6) AS buzz,
              round((10 - GoldsteinScale) * (1 + (100 - AvgTone) / 50), 6) AS weighted_gravity
       FROM silver_events""",
    digits=6,
)
def _(layers):
    enriched = profiles.enrich_events(layers.events)
    return enriched.select("GlobalEventID", "buzz", "weighted_gravity")


LAST_DAYS = """CAST(Datetime AS DATE) IN (
    SELECT DISTINCT CAST(Datetime AS DATE) AS d FROM silver_candles ORDER BY d DESC LIMIT 10)"""


@query(
    "candle_body",
    f"""SELECT Datetime, CASE WHEN Close >= Open THEN 'up' ELSE 'down' END AS direction,
               round(Close - Open, 6) AS body, Low AS wick_low, High AS wick_high
        FROM silver_candles WHERE {LAST_DAYS}""",
    digits=6,
)
def _(layers):
    return profiles.candle_shapes(layers.candles)


@query("last_days", f"SELECT Datetime, Close FROM silver_candles WHERE {LAST_DAYS}")
def _(layers):
    return profile.last_distinct_days(layers.candles.select("Datetime", "Close"), "Datetime")


@query(
    "actor_or_filter",
    """SELECT GlobalEventID, Actor1Code, Actor2Code FROM typed_events
       WHERE Actor1Code = 'GOVOPC' OR Actor2Code = 'GOVOPC'""",
)
def _(layers):
    found = profiles.actor_events(layers.typed_events, "GOVOPC")
    return found.select("GlobalEventID", "Actor1Code", "Actor2Code")


@query(
    "top_stress",
    """SELECT Datetime, Close, Variation_Pct, round(geo_score_raw_smoothed, 6)
              AS geo_score_raw_smoothed, score_pct_7d, total_event_count,
              list_min(period_actor_countries) AS period_actor_country, gap_duration_15m
       FROM candle_gold ORDER BY geo_score_raw_smoothed DESC, Datetime LIMIT 20""",
)
def _(layers):
    return profiles.top_stress(layers.gold)


@query(
    "max_row",
    """SELECT Datetime, Variation_Pct FROM silver_candles
       ORDER BY Variation_Pct DESC NULLS LAST, Datetime LIMIT 1""",
)
def _(layers):
    return profile.top_rows(layers.candles, "Variation_Pct", 1, ["Datetime"]).select(
        "Datetime", "Variation_Pct"
    )


@query(
    "head_tail",
    """(SELECT 'head' AS part, Datetime, Close FROM silver_candles ORDER BY Datetime LIMIT 5)
       UNION ALL
       (SELECT 'tail', Datetime, Close FROM silver_candles ORDER BY Datetime DESC LIMIT 5)""",
)
def _(layers):
    part = layers.candles.select("Datetime", "Close")
    first = profile.head(part, ["Datetime"]).select(F.lit("head").alias("part"), "*")
    return first.unionByName(profile.tail(part, ["Datetime"]).select(F.lit("tail").alias("part"), "*"))


# --- calibration ----------------------------------------------------------------------


def grid_sql(source: str, change: str = "Variation_Pct") -> str:
    return f"""
reopened AS (
  SELECT geo_score_raw_max AS peak, geo_score_raw_sum / gap_duration_15m AS mean, {change} AS change
  FROM {source} WHERE gap_duration_15m > 1 AND Variation_Pct IS NOT NULL),
points AS (
  SELECT round(s / 20.0, 4)::DOUBLE AS alpha, change,
         round(s / 20.0, 4)::DOUBLE * peak + (1 - round(s / 20.0, 4)::DOUBLE) * mean AS score
  FROM reopened, (SELECT unnest(range(21)) AS s)),
ranked AS (
  SELECT alpha, rank() OVER (PARTITION BY alpha ORDER BY score)
                + (count(*) OVER (PARTITION BY alpha, score) - 1) / 2.0 AS x,
         rank() OVER (PARTITION BY alpha ORDER BY change)
                + (count(*) OVER (PARTITION BY alpha, change) - 1) / 2.0 AS y
  FROM points),
grid AS (SELECT alpha, count(*) AS n, corr(x, y) AS spearman_rho, abs(corr(x, y)) AS abs_rho
         FROM ranked GROUP BY alpha)"""


GRID_SELECT = """SELECT alpha, n, round(spearman_rho, 6) AS spearman_rho,
                        round(abs_rho, 6) AS abs_rho FROM grid"""


@query("alpha_grid", GRID_SELECT, extra=grid_sql("candle_gold"), digits=6)
def _(layers):
    return calibration.alpha_grid(layers.gold)


@query("alpha_grid_per_row", GRID_SELECT, extra=grid_sql("gold"), digits=6)
def _(layers):
    return calibration.alpha_grid(layers.gold, dedup=False)


@query(
    "alpha_grid_absolute", GRID_SELECT, extra=grid_sql("candle_gold", "abs(Variation_Pct)"), digits=6
)
def _(layers):
    return calibration.alpha_grid(layers.gold, absolute=True)


@query(
    "alpha_best",
    """SELECT alpha, round(spearman_rho, 6) AS spearman_rho,
              round((SELECT spearman_rho FROM grid WHERE alpha = 0.8), 6) AS current_rho,
              round(abs_rho - (SELECT abs_rho FROM grid WHERE alpha = 0.8), 6) AS gain
       FROM grid ORDER BY round(abs_rho, 12) DESC, alpha LIMIT 1""",
    extra=grid_sql("candle_gold"),
    digits=6,
)
def _(layers):
    grid = calibration.alpha_grid(layers.gold)
    return calibration.calibrate_alpha(grid.withColumn("abs_rho", F.round("abs_rho", 12)))


@query(
    "alpha_top5",
    """SELECT alpha, round(spearman_rho, 6) AS spearman_rho FROM grid
       ORDER BY round(abs_rho, 12) DESC, alpha LIMIT 5""",
    extra=grid_sql("candle_gold"),
    digits=6,
)
def _(layers):
    grid = calibration.alpha_grid(layers.gold).withColumn("abs_rho", F.round("abs_rho", 12))
    return calibration.best_alphas(grid).select("alpha", "spearman_rho")


# The two tails of the t distribution, its density integrated by Simpson's rule.
TAILS_SQL = (
    grid_sql("candle_gold")
    + """,
tested AS (SELECT *, n - 2.0 AS v,
                  spearman_rho * sqrt((n - 2) / ((1 - spearman_rho) * (1 + spearman_rho))) AS t
           FROM grid),
density AS (SELECT alpha, CASE WHEN i % 2000 = 0 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                          * pow(1 + pow(t * i / 2000.0, 2) / v, -(v + 1) / 2) AS y
            FROM tested, (SELECT unnest(range(2001)) AS i)),
area AS (SELECT alpha, sum(y) AS s FROM density GROUP BY alpha)"""
)


@query(
    "alpha_significance",
    """SELECT alpha, n, round(spearman_rho, 6) AS spearman_rho, round(t, 6) AS t,
              round(1 - 2 * abs(t) / 6000 * s * exp(lgamma((v + 1) / 2) - lgamma(v / 2))
                    / sqrt(v * pi()), 6) AS p_value
       FROM tested JOIN area USING (alpha)""",
    extra=TAILS_SQL,
    digits=6,
)
def _(layers):
    grid = calibration.alpha_grid(layers.gold)
    return calibration.with_significance(grid).select("alpha", "n", "spearman_rho", "t", "p_value")


# --- landing --------------------------------------------------------------------------


@query(
    "catalogue_exports",
    """SELECT CAST(CAST(epoch(slot) AS BIGINT) % 9973 AS VARCHAR) AS size,
              md5(strftime(slot, '%Y%m%d%H%M%S')) AS hash,
              'http://feed.example/v2/' || strftime(slot, '%Y%m%d%H%M%S') || '.export.CSV.zip'
                AS url, slot
       FROM (SELECT DISTINCT slot FROM activity) WHERE slot >= TIMESTAMP '2024-01-10'""",
)
def _(layers):
    catalogue = exports.parse_catalogue(feed.catalogue_lines(layers.activity))
    return exports.export_files(catalogue, "2024-01-10")


COMPLETE_SQL = """
expected AS (
  SELECT d AS day, d + to_minutes(15 * i) AS slot
  FROM (SELECT DISTINCT CAST(Day AS TIMESTAMP) AS d FROM typed_events),
       (SELECT unnest(range(96)) AS i)),
landed AS (SELECT DISTINCT DATEADDED AS slot FROM typed_events)"""


@query(
    "slot_completeness",
    """SELECT CAST(CAST(day AS DATE) AS VARCHAR) AS day, count(*) AS expected,
              count(l.slot) AS present, count(*) - count(l.slot) AS missing
       FROM expected LEFT JOIN landed l USING (slot) GROUP BY 1""",
    extra=COMPLETE_SQL,
)
def _(layers):
    days = layers.typed_events.select(F.col("Day").alias("day")).distinct()
    return day_report(layers.typed_events, days, "DATEADDED")


@query(
    "missing_slots",
    """SELECT CAST(CAST(day AS DATE) AS VARCHAR) AS day, slot
       FROM expected ANTI JOIN landed USING (slot)""",
    extra=COMPLETE_SQL,
)
def _(layers):
    days = layers.typed_events.select(F.col("Day").alias("day")).distinct()
    return slots.missing_slots(layers.typed_events, days, "DATEADDED")


@query("archive_scan", f"SELECT {TYPED_SQL} FROM typed_events")
def _(layers):
    rows = exports.unpack_archives(feed.packed(layers.raw_events))
    return events.cast_events(rows)


@query("tsv_scan", f"SELECT {TYPED_SQL} FROM typed_events")
def _(layers):
    path = fresh_folder(layers.spark, "exports")
    layers.raw_events.write.option("sep", "\t").option("header", False).csv(path)
    return events.cast_events(exports.read_tsv(layers.spark, path))


# --- stored tables --------------------------------------------------------------------


@query("table_rebuild", f"SELECT {SILVER_SQL} FROM silver_events", digits=6)
def _(layers):
    path = fresh_folder(layers.spark, "events")
    lake.write_whole(layers.events, path, "DATEADDED")
    stored = lake.read_table(layers.spark, path, SILVER_EVENTS)
    lake.write_whole(stored, path, "DATEADDED")  # a table may replace itself
    layers.spark.catalog.refreshByPath(path)
    return lake.read_table(layers.spark, path, SILVER_EVENTS)


@query("events_stream", f"SELECT {SILVER_SQL} FROM silver_events", digits=6)
def _(layers):
    raw, silver, state = (fresh_folder(layers.spark, n) for n in ("raw", "silver", "state"))
    layers.raw_events.write.parquet(raw)
    landed.clean_landed_events(layers.spark, raw, silver, state, RULES).awaitTermination()
    return lake.read_table(layers.spark, silver, SILVER_EVENTS)


@query(
    "document_sink",
    """SELECT sha256(strftime(Datetime, '%Y-%m-%dT%H:%M:%SZ') || '|'
                     || coalesce(period_actor_country, '')) AS "_id",
              strftime(Datetime, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp", Volume, period_actor_country
       FROM gold""",
)
def _(layers):
    path = fresh_folder(layers.spark, "documents")
    documents.write_documents(layers.gold, path)
    body = "timestamp string, Volume bigint, period_actor_country string"
    lines = layers.spark.read.text(path).select(
        F.from_json("value", "_id string, _source string").alias("d")
    )
    return lines.select("d._id", F.from_json("d._source", body).alias("s")).select("_id", "s.*")
