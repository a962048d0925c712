"""Declared schema of every layer, and conforming a frame to one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """Schema from ``name type, ...`` (the DDL parser needs a running session)."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The 61 positional columns of a raw event export.
RAW_EVENT_COLUMNS = """
GlobalEventID Day MonthYear Year FractionDate
Actor1Code Actor1Name Actor1CountryCode Actor1KnownGroupCode Actor1EthnicCode
Actor1Religion1Code Actor1Religion2Code Actor1Type1Code Actor1Type2Code Actor1Type3Code
Actor2Code Actor2Name Actor2CountryCode Actor2KnownGroupCode Actor2EthnicCode
Actor2Religion1Code Actor2Religion2Code Actor2Type1Code Actor2Type2Code Actor2Type3Code
IsRootEvent EventCode EventBaseCode EventRootCode QuadClass
GoldsteinScale NumMentions NumSources NumArticles AvgTone
Actor1Geo_Type Actor1Geo_FullName Actor1Geo_CountryCode Actor1Geo_ADM1Code
Actor1Geo_ADM2Code Actor1Geo_Lat Actor1Geo_Long Actor1Geo_FeatureID
Actor2Geo_Type Actor2Geo_FullName Actor2Geo_CountryCode Actor2Geo_ADM1Code
Actor2Geo_ADM2Code Actor2Geo_Lat Actor2Geo_Long Actor2Geo_FeatureID
ActionGeo_Type ActionGeo_FullName ActionGeo_CountryCode ActionGeo_ADM1Code
ActionGeo_ADM2Code ActionGeo_Lat ActionGeo_Long ActionGeo_FeatureID
DATEADDED SOURCEURL
""".split()

RAW_EVENTS = T.StructType([T.StructField(c, T.StringType()) for c in RAW_EVENT_COLUMNS])

# The columns kept from a raw event, with the type each takes once cleaned.
TYPED_EVENTS = _struct(
    """
    GlobalEventID bigint, Day date, DATEADDED timestamp,
    Actor1Code string, Actor1Name string, Actor1CountryCode string, Actor1Type1Code string,
    Actor2Code string, Actor2Name string, Actor2CountryCode string, Actor2Type1Code string,
    EventCode int, EventRootCode int, QuadClass int, GoldsteinScale double, IsRootEvent int,
    ActionGeo_CountryCode string, ActionGeo_Lat double, ActionGeo_Long double,
    NumMentions int, NumSources int, NumArticles int, AvgTone double
    """
)

SCORE_COLUMNS = ["geo_I", "geo_B", "geo_S", "geo_score_raw"]

SILVER_EVENTS = T.StructType(
    TYPED_EVENTS.fields
    + [T.StructField(c, T.DoubleType()) for c in SCORE_COLUMNS]
    + [T.StructField("actor_countries", T.ArrayType(T.StringType()))]
)

TYPED_CANDLES = _struct(
    "Datetime timestamp, Open double, High double, Low double, Close double, Volume bigint"
)

RAW_CANDLES = T.StructType([T.StructField(f.name, T.StringType()) for f in TYPED_CANDLES])

SILVER_CANDLES = T.StructType(
    TYPED_CANDLES.fields
    + [
        T.StructField("Volatility_Range", T.DoubleType()),
        T.StructField("Variation_Pct", T.DoubleType()),
    ]
)

GOLD = T.StructType(
    SILVER_CANDLES.fields
    + [T.StructField(f"{c}_smoothed", T.DoubleType()) for c in SCORE_COLUMNS]
    + [T.StructField(f"{c}_sum", T.DoubleType()) for c in SCORE_COLUMNS]
    + [
        T.StructField("geo_score_raw_max", T.DoubleType()),
        T.StructField("total_event_count", T.DoubleType()),
        T.StructField("gap_duration_15m", T.LongType()),
        T.StructField("score_pct_7d", T.DoubleType()),
        T.StructField("period_actor_country", T.StringType()),
    ]
)

# Serving documents: types of the index mapping (float, integer, keyword, date).
DOCUMENTS = _struct(
    """
    timestamp string, Open float, High float, Low float, Close float, Volume bigint,
    Volatility_Range float, Variation_Pct float,
    geo_I_smoothed float, geo_B_smoothed float, geo_S_smoothed float, geo_score_raw_smoothed float,
    geo_I_sum float, geo_B_sum float, geo_S_sum float, geo_score_raw_sum float,
    total_event_count float, gap_duration_15m int, period_actor_country string,
    score_pct_7d float
    """
)


# Integer from text: digits after a decimal point are cut off. Texts with a point
# are told apart first, since a cast that fails costs far more than one that works.
_WHOLE = (
    "try_cast(CASE WHEN NOT contains({c}, '.') THEN {c}"
    " WHEN {c} RLIKE r'^\\s*[+-]?\\d+\\.\\d*\\s*$' THEN substring_index({c}, '.', 1) END AS {kind})"
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast to its types; bad values turn null."""
    have = {f.name: f.dataType for f in df.schema}

    def field(f: T.StructField) -> str:
        name, kind = f"`{f.name}`", f.dataType.simpleString()
        if have[f.name] == f.dataType:
            return name
        if isinstance(have[f.name], T.StringType) and isinstance(f.dataType, T.IntegralType):
            return f"{_WHOLE.format(c=name, kind=kind)} AS {name}"
        return f"try_cast({name} AS {kind}) AS {name}"

    return df.selectExpr(*[field(f) for f in schema])
