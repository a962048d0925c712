"""Index rows as documents, and the dashboard's queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offhours.functions.moments import finite_or_null, floor_slot, iso8601
from offhours.operators.merge import keep_first
from offhours.operators.ordered import fill_between
from offhours.operators.profile import value_counts
from offhours.schemas import DOCUMENTS

# Histogram intervals to choose from, in seconds.
AUTO_INTERVALS = (900, 3_600, 10_800, 43_200, 86_400)


def to_documents(gold: DataFrame) -> DataFrame:
    """Typed documents: ISO-8601 ``timestamp``, mapped types, NaN and infinity as null.

    Mapped columns that the input lacks are left out.
    """
    if "Datetime" not in gold.columns:
        raise ValueError(f"column Datetime is missing; there are {gold.columns}")
    have = {**dict(gold.dtypes), "timestamp": "string"}
    source = gold.withColumn("timestamp", iso8601("Datetime"))

    def field(f: T.StructField):
        value = F.col(f.name)
        if have[f.name] in ("float", "double"):
            value = finite_or_null(value)
        value = value.try_cast(f.dataType)
        # A finite double may be infinite as a float.
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            value = finite_or_null(value)
        return value.alias(f.name)

    return source.select(*[field(f) for f in DOCUMENTS if f.name in have])


def absent_columns(gold: DataFrame) -> list[str]:
    """Mapped columns that the input lacks."""
    have = {*gold.columns, "timestamp"}
    return sorted(f.name for f in DOCUMENTS if f.name not in have)


def with_document_id(documents: DataFrame) -> DataFrame:
    """Add ``_id``: the same row always gets the same id, so re-sending replaces it."""
    key = F.concat_ws("|", "timestamp", F.coalesce("period_actor_country", F.lit("")))
    return documents.withColumn("_id", F.sha2(key, 256))


def as_json(documents: DataFrame) -> DataFrame:
    """One JSON text per document, nulls written out."""
    fields = [c for c in documents.columns if c != "_id"]
    body = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("_source")
    return documents.select(*[c for c in ["_id"] if c in documents.columns], body)


def last_days(df: DataFrame, ts: str, days: int = 90, as_of: str | None = None) -> DataFrame:
    """Rows of the last ``days`` days up to ``as_of`` (default: now)."""
    until = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    return df.where((F.col(ts) >= until - F.make_dt_interval(F.lit(days))) & (F.col(ts) <= until))


def one_per_candle(gold: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Undo the split by country: measures repeat on every row of a candle."""
    return keep_first(gold.select("Datetime", *fields), ["Datetime"], [])


def average_over_time(
    df: DataFrame, fields: Sequence[str], seconds: int = 900, ts: str = "Datetime"
) -> DataFrame:
    """Average of each field per fixed-width bucket."""
    bucket = floor_slot(ts, seconds).alias("bucket")
    return df.groupBy(bucket).agg(*[F.avg(c).alias(c) for c in fields])


def average_auto(
    df: DataFrame, fields: Sequence[str], max_buckets: int = 100, ts: str = "Datetime"
) -> DataFrame:
    """As ``average_over_time`` with the finest interval that stays within ``max_buckets``.

    Above the listed intervals it is as many whole days as the span asks for. A limit of 1
    gives one bucket of whole days, from the first day on, wherever days end.
    """
    if max_buckets < 1:
        raise ValueError("at least one bucket is needed")
    if max_buckets == 1:
        return _one_bucket(df, fields, ts)
    span = df.agg(F.struct(F.min(F.unix_seconds(ts)), F.max(F.unix_seconds(ts))).alias("s"))
    low, high = F.col("s.col1"), F.col("s.col2")

    def buckets(width: int):
        return F.floor(high / width) - F.floor(low / width) + 1

    day = AUTO_INTERVALS[-1]
    # n buckets of w cover any span of (n - 1) w, wherever it begins.
    days = F.ceil((high - low + 1) / F.lit(day * max(1, max_buckets - 1)))
    width = F.coalesce(
        *[F.when(buckets(w) <= max_buckets, F.lit(w)) for w in AUTO_INTERVALS], days * day
    ).cast("int")
    chosen = span.select(width).scalar()
    with_width = df.withColumn("interval_seconds", chosen)
    bucket = floor_slot(ts, F.col("interval_seconds")).alias("bucket")
    return with_width.groupBy(bucket, "interval_seconds").agg(
        *[F.avg(c).alias(c) for c in fields]
    )


def _one_bucket(df: DataFrame, fields: Sequence[str], ts: str) -> DataFrame:
    day = AUTO_INTERVALS[-1]
    first, last = (F.floor(f(F.unix_seconds(ts)) / day) for f in (F.min, F.max))
    whole = df.where(F.col(ts).isNotNull()).agg(
        F.timestamp_seconds(first * day).alias("bucket"),
        ((last - first + 1) * day).cast("int").alias("interval_seconds"),
        *[F.avg(c).alias(c) for c in fields],
    )
    return whole.where(F.col("bucket").isNotNull())


def long_series(buckets: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Buckets as ``(field, bucket, value)``, buckets without a value left out."""
    long = buckets.unpivot(["bucket"], list(fields), "field", "value")
    return long.where(F.col("value").isNotNull())


def fill_series(
    buckets: DataFrame, fields: Sequence[str], seconds: int = 900, linear: bool = True
) -> DataFrame:
    """Each field's series with its empty buckets, interpolated or null."""
    series = long_series(buckets, fields)
    return fill_between(series, "bucket", ["value"], seconds, ["field"], linear)


def fill_empty_buckets(
    buckets: DataFrame, fields: Sequence[str], seconds: int = 900
) -> DataFrame:
    """Buckets with the empty ones between first and last, fields null."""
    return fill_between(buckets, "bucket", list(fields), seconds)


def top_terms(df: DataFrame, field: str, size: int = 10) -> DataFrame:
    """Most frequent values by record count; ties in value order."""
    return value_counts(df, field, size)


def country_counts(countries: DataFrame, gold: DataFrame, code: str = "iso3") -> DataFrame:
    """Every country of the dimension with its record count; null where it has none.

    The index is counted per country first, so the join is between two tables
    with one row per country.
    """
    counts = gold.groupBy(F.col("period_actor_country").alias(code)).agg(
        F.count(F.lit(1)).alias("n")
    )
    return countries.join(counts, code, "left")
