"""The two feeds and the pipeline layers as SQL, for checking against DuckDB.

``layers()`` is one WITH clause; each query's SQL selects from its members.
"""

from __future__ import annotations

from offhours.sources.feed import ACTOR1, ACTOR2, ACTOR_TYPES, FEED_START, PLACES


# Fixed values, written out again so that the SQL does not depend on the code it checks:
# weights by ISO3 code, FIPS codes of the same countries, and root codes of major events.
ISO3_WEIGHT = {
    "SAU": 6, "RUS": 6, "IRN": 6, "IRQ": 6, "USA": 4, "ARE": 3, "KWT": 3, "CAN": 3, "NOR": 3,
    "KAZ": 3, "BRA": 3, "VEN": 3, "LBY": 3, "NGA": 3, "AGO": 3, "CHN": 2, "IND": 2, "MEX": 2,
    "EGY": 2, "TUR": 2, "PAN": 2, "YEM": 2, "JPN": 2, "KOR": 2, "DEU": 2, "FRA": 2, "GBR": 2,
}
FIPS2_TO_ISO3 = {
    "SA": "SAU", "RS": "RUS", "IR": "IRN", "IZ": "IRQ", "US": "USA", "AE": "ARE", "KU": "KWT",
    "CA": "CAN", "NO": "NOR", "KZ": "KAZ", "BR": "BRA", "VE": "VEN", "LY": "LBY", "NI": "NGA",
    "AO": "AGO", "CH": "CHN", "IN": "IND", "MX": "MEX", "EG": "EGY", "TU": "TUR", "PM": "PAN",
    "YM": "YEM", "JA": "JPN", "KS": "KOR", "GM": "DEU", "FR": "FRA", "UK": "GBR",
}
FIPS2_WEIGHT = {
    "SA": 6, "RS": 6, "IR": 6, "IZ": 6, "US": 4, "AE": 3, "KU": 3, "CA": 3, "NO": 3, "KZ": 3,
    "BR": 3, "VE": 3, "LY": 3, "NI": 3, "AO": 3, "CH": 2, "IN": 2, "MX": 2, "EG": 2, "TU": 2,
    "PM": 2, "YM": 2, "JA": 2, "KS": 2, "GM": 2, "FR": 2, "UK": 2,
}
MAJOR_ROOT_CODES = (6, 8, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20)


def case(code: str, table: dict, default: str = "NULL") -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    arms = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in table.items())
    return f"(CASE {code} {arms} ELSE {default} END)"


def pick(options: list, index: str) -> str:
    items = ", ".join("NULL" if o is None else f"'{o}'" for o in options)
    return f"([{items}])[CAST({index} AS INTEGER) + 1]"


def clip(x: str) -> str:
    return f"greatest(0.0, least(1.0, {x}))"


PLACE_ISO3 = case("ActionGeo_CountryCode", FIPS2_TO_ISO3)
ACTOR1_ISO3 = f"coalesce({case('Actor1CountryCode', FIPS2_TO_ISO3)}, Actor1CountryCode)"
ACTOR2_ISO3 = f"coalesce({case('Actor2CountryCode', FIPS2_TO_ISO3)}, Actor2CountryCode)"
W1 = case("Actor1CountryCode", ISO3_WEIGHT, "1")
W2 = case("Actor2CountryCode", ISO3_WEIGHT, "1")
W3 = case("ActionGeo_CountryCode", FIPS2_WEIGHT, "1")
ROOTS = ", ".join(str(c) for c in MAJOR_ROOT_CODES)
MAJOR = f"""Day >= DATE '{FEED_START}' AND NumArticles >= 4 AND abs(GoldsteinScale) >= 5.0
    AND QuadClass >= 2 AND EventRootCode IN ({ROOTS})"""
SCORES = ["geo_I", "geo_B", "geo_S", "geo_score_raw"]

LAYERS = f"""
activity AS (
  SELECT event_id, user_id, event_type, value, ts,
         time_bucket(INTERVAL '15 minutes', ts) AS slot,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events
),
base_events AS (
  SELECT event_id AS GlobalEventID, CAST(slot AS DATE) AS Day, slot AS DATEADDED,
         CASE WHEN event_id % 50 = 7 THEN 'GOVOPC' ELSE {pick(ACTOR1, 'user_id % 8')} END
           AS Actor1Code,
         'ACTOR ' || {pick(ACTOR1, 'user_id % 8')} AS Actor1Name,
         {pick(ACTOR1, 'user_id % 8')} AS Actor1CountryCode,
         {pick(ACTOR_TYPES, 'event_id % 3')} AS Actor1Type1Code,
         CASE WHEN event_id % 50 = 9 THEN 'GOVOPC' ELSE {pick(ACTOR2, 'event_id % 5')} END
           AS Actor2Code,
         'ACTOR ' || {pick(ACTOR2, 'event_id % 5')} AS Actor2Name,
         {pick(ACTOR2, 'event_id % 5')} AS Actor2CountryCode,
         {pick(ACTOR_TYPES, 'event_id % 2')} AS Actor2Type1Code,
         CAST((event_id % 20 + 1) * 10 AS INTEGER) AS EventCode,
         CAST(event_id % 20 + 1 AS INTEGER) AS EventRootCode,
         CAST(event_id % 4 + 1 AS INTEGER) AS QuadClass,
         CAST(((event_id * 7) % 41 - 20) * 20 AS DOUBLE) / 41 AS GoldsteinScale,
         CAST(event_id % 2 AS INTEGER) AS IsRootEvent,
         {pick(PLACES, 'event_id % 7')} AS ActionGeo_CountryCode,
         CAST(event_id % 180 - 90 AS DOUBLE) / 2.0 AS ActionGeo_Lat,
         CAST(event_id % 360 - 180 AS DOUBLE) / 2.0 AS ActionGeo_Long,
         CAST((k % 20 + 1) * 3 AS INTEGER) AS NumMentions,
         CAST((k % 20 + 2) // 2 AS INTEGER) AS NumSources,
         CAST(k % 20 + 1 AS INTEGER) AS NumArticles,
         CASE WHEN event_id % 97 <> 0 THEN CAST(((event_id * 13) % 201 - 100) * 100 AS DOUBLE) / 397 END
           AS AvgTone
  FROM activity WHERE event_type <> 'purchase'
),
typed_events AS (
  SELECT * FROM base_events
  UNION ALL SELECT * FROM base_events WHERE GlobalEventID % 50 = 0
),
weighted AS (
  SELECT *, {W1} AS c1, {W2} AS c2, {W3} AS c3,
         {PLACE_ISO3} AS p3, {ACTOR1_ISO3} AS a1, {ACTOR2_ISO3} AS a2
  FROM base_events WHERE {MAJOR}
),
scored AS (
  SELECT *,
         greatest(c1, c2, c3) + 0.5 * (c1 + c2 + c3 - greatest(c1, c2, c3) - 2) AS I_,
         ln(1.0 + NumArticles) AS B_,
         1.0 + 1.5 * {clip('-GoldsteinScale / 10.0')} + {clip('-AvgTone / 100.0')} AS S_,
         list_filter(
           [p3, CASE WHEN a1 IS DISTINCT FROM p3 THEN a1 END,
            CASE WHEN a2 IS DISTINCT FROM p3 AND a2 IS DISTINCT FROM a1 THEN a2 END],
           lambda x: x IS NOT NULL) AS actor_countries
  FROM weighted
),
silver_events AS (
  SELECT * EXCLUDE (c1, c2, c3, p3, a1, a2, I_, B_, S_, actor_countries),
         CAST(I_ AS DOUBLE) AS geo_I, CAST(B_ AS DOUBLE) AS geo_B, CAST(S_ AS DOUBLE) AS geo_S,
         CAST(I_ AS DOUBLE) * CAST(I_ AS DOUBLE) * CAST(B_ AS DOUBLE) * CAST(S_ AS DOUBLE)
           AS geo_score_raw,
         actor_countries
  FROM scored
),
bars AS (
  SELECT slot, first(value ORDER BY ts, event_id) AS o, max(value) AS h, min(value) AS l,
         last(value ORDER BY ts, event_id) AS c, count(*) AS v,
         CAST(floor(epoch(slot) / 900) AS BIGINT) AS number
  FROM activity
  WHERE event_type = 'purchase'
  GROUP BY slot
),
typed_candles AS (
  SELECT slot AS Datetime, o + copy AS Open, h + copy AS High, l + copy AS Low,
         CASE WHEN number % 53 <> 0 THEN c + copy END AS Close, v AS Volume, copy
  FROM (SELECT *, 0 AS copy FROM bars UNION ALL SELECT *, 1 FROM bars WHERE number % 40 = 0)
),
unique_candles AS (
  SELECT * EXCLUDE (copy) FROM typed_candles WHERE copy = 0
),
silver_candles AS (
  SELECT *, round(High - Low, 4) AS Volatility_Range,
         round((Close - lag(Close) OVER w) / nullif(lag(Close) OVER w, 0) * 100, 4) AS Variation_Pct
  FROM unique_candles WINDOW w AS (ORDER BY Datetime)
),
slots AS (
  SELECT DATEADDED, {', '.join(f'sum({c}) AS {c}' for c in SCORES)}, count(*) AS event_count,
         first(actor_countries ORDER BY geo_score_raw DESC, actor_countries DESC)
           AS actor_countries
  FROM silver_events GROUP BY DATEADDED
),
timeline AS (
  SELECT coalesce(Datetime, DATEADDED) AS master_datetime,
         CASE WHEN Close IS NOT NULL THEN 1 ELSE 0 END AS market_open,
         Datetime, Close, {', '.join(f'coalesce({c}, 0.0) AS {c}' for c in SCORES)},
         CAST(coalesce(event_count, 0) AS DOUBLE) AS event_count,
         coalesce(actor_countries, CAST([] AS VARCHAR[])) AS actor_countries
  FROM silver_candles FULL OUTER JOIN slots ON Datetime = DATEADDED
),
assigned AS (
  SELECT * FROM (
    SELECT *, min(CASE WHEN market_open = 1 THEN master_datetime END) OVER (
             ORDER BY master_datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING
           ) AS target_open_datetime
    FROM timeline)
  WHERE target_open_datetime IS NOT NULL
),
period_sums AS (
  SELECT target_open_datetime, count(*) AS gap_duration_15m, sum(event_count) AS total_event_count,
         {', '.join(f'sum({c}) AS {c}_sum, max({c}) AS {c}_max' for c in SCORES)},
         first(actor_countries ORDER BY geo_score_raw DESC, actor_countries DESC)
           AS period_actor_countries
  FROM assigned GROUP BY target_open_datetime
),
periods AS (
  SELECT *, {', '.join(
      f'round(0.25 * {c}_max + 0.75 * ({c}_sum / gap_duration_15m), 6) AS {c}_smoothed'
      for c in SCORES)}
  FROM period_sums
),
candle_periods AS (
  SELECT c.*, p.* EXCLUDE (target_open_datetime)
  FROM silver_candles c JOIN periods p ON c.Datetime = p.target_open_datetime
),
candle_gold AS (
  SELECT *, round(CASE WHEN hi > lo THEN (geo_score_raw_smoothed - lo) / (hi - lo) * 100
                       ELSE 50.0 END, 2) AS score_pct_7d
  FROM (SELECT *, min(geo_score_raw_smoothed) OVER w AS lo,
               max(geo_score_raw_smoothed) OVER w AS hi
        FROM candle_periods
        WINDOW w AS (ORDER BY Datetime ROWS BETWEEN 672 PRECEDING AND CURRENT ROW))
),
gold AS (
  SELECT Datetime, Open, High, Low, Close, Volume, Volatility_Range, Variation_Pct,
         {', '.join(f'{c}_smoothed' for c in SCORES)}, {', '.join(f'{c}_sum' for c in SCORES)},
         geo_score_raw_max, total_event_count, gap_duration_15m, score_pct_7d,
         unnest(CASE WHEN len(period_actor_countries) = 0 THEN [NULL]
                ELSE period_actor_countries END) AS period_actor_country
  FROM candle_gold
)
"""


def with_layers(select: str, extra: str = "") -> str:
    return f"WITH {LAYERS.strip()}{',' + extra if extra else ''}\n{select}"
