"""Profiling: one-pass aggregates, distributions, duplicates, extremes."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offhours.functions.market import percent_change
from offhours.operators.merge import keep_first
from offhours.operators.ordered import DAY_SECONDS, lag_in_time, rolling_measures, with_position
from offhours.operators.ranking import exact_quantiles

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def _missing(f: T.StructField) -> Column:
    """True for null, and for NaN where the type has one."""
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _known(df: DataFrame, column: str) -> Column:
    """The column with null in place of NaN, as pandas treats it."""
    return F.when(~_missing(df.schema[column]), F.col(column))


def _as_rows(one_row: DataFrame, label: str, parts: dict[str, Sequence[str]]) -> DataFrame:
    """Turn one wide row into a row per label; ``parts`` maps a label to its columns."""
    names = [c.split(".", 1)[1] for c in next(iter(parts.values()))]
    entries = [
        F.struct(
            F.lit(key).alias(label),
            *[F.col(f"`{c}`").alias(name) for c, name in zip(columns, names)],
        )
        for key, columns in parts.items()
    ]
    return one_row.select(F.inline(F.array(*entries)))


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles and max per numeric column.

    NaN counts as missing. All but the quartiles come from one pass that combines map-side.
    """
    columns = list(columns or numeric_columns(df))
    doubles = df.select(
        *[_known(df, c).cast("double").alias(c) for c in columns]
    )
    wanted = {
        "count": F.count,
        "mean": F.avg,
        "std": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    wide = doubles.agg(
        *[build(c).alias(f"{c}.{name}") for c in columns for name, build in wanted.items()]
    )
    basic = _as_rows(wide, "column", {c: [f"{c}.{name}" for name in wanted] for c in columns})
    long = doubles.unpivot([], columns, "column", "value")
    quartiles = exact_quantiles(long, ["column"], "value", QUARTILES)
    return basic.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", *QUARTILES, "max"
    )


def column_stats(df: DataFrame, column: str) -> DataFrame:
    """Min, max, mean, exact median, sample std and range of one column; NaN is missing."""
    df = df.select(_known(df, column).alias(column))
    median = exact_quantiles(df.select(column), [], column, {"median": 0.5}).scalar()
    return df.agg(
        F.min(column).alias("min"),
        F.max(column).alias("max"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        (F.max(column) - F.min(column)).alias("range"),
    ).withColumn("median", median)


def time_range(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("first"), F.max(ts).alias("last"))


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values (null or NaN) per column, and their share of all cells in percent."""
    columns = df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(_missing(f)).alias(f"{f.name}.missing") for f in df.schema],
    )
    total = sum((F.col(f"`{c}.missing`") for c in columns), F.lit(0))
    cells = F.col("_rows") * len(columns)
    share = F.round(F.try_divide(total * 100.0, cells), 2)
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}.missing`").alias("missing"))
        for c in columns
    ]
    return wide.select(
        F.explode(F.array(*entries)).alias("_e"), share.alias("total_missing_pct")
    ).select("_e.column", "_e.missing", "total_missing_pct")


def duplicate_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows, fully repeated rows and rows with a repeated key.

    Copies are counted in two steps, whole rows then keys, each combining
    map-side, so a heavily repeated row is not collected anywhere.
    """
    whole = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    keyed = whole.groupBy(*key).agg(
        F.sum("_copies").alias("_rows"), F.count(F.lit(1)).alias("_distinct_rows")
    )
    return keyed.agg(
        F.sum("_rows").alias("rows"),
        F.sum(F.col("_rows") - F.col("_distinct_rows")).alias("duplicate_rows"),
        F.sum(F.col("_rows") - 1).alias("duplicate_keys"),
    )


def distinct_ratio(df: DataFrame, ts: str) -> DataFrame:
    """Rows, distinct timestamps, distinct days, and rows per timestamp."""
    per_stamp = df.groupBy(ts).agg(F.count(F.lit(1)).alias("_n"))
    per_day = per_stamp.groupBy(F.to_date(ts).alias("_d")).agg(
        F.sum("_n").alias("_n"), F.count(ts).alias("_stamps")
    )
    totals = per_day.agg(
        F.sum("_n").alias("rows"),
        F.sum("_stamps").alias("timestamps"),
        F.count("_d").alias("days"),
    )
    return totals.withColumn(
        "rows_per_timestamp", F.round(F.try_divide("rows", "timestamps"), 2)
    )


def rows_per_day(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def per_day_summary(df: DataFrame, ts: str) -> DataFrame:
    """Days that have rows, and the mean rows on them."""
    per_day = rows_per_day(df.where(F.col(ts).isNotNull()), ts)
    return per_day.agg(F.count("day").alias("days"), F.avg("n").alias("mean_per_day"))


def rows_per_hour(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(F.hour(ts).alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def totals(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.sum(column).alias("total"), F.avg(column).alias("mean"))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts in equal bins from min to max, empty bins included, the last one closed.

    A single-valued column gets one unit around its value. NaN is missing.
    """
    value = _known(df, column).cast("double")
    low, high = F.col("_bounds.low"), F.col("_bounds.high")
    start = F.when(high > low, low).otherwise(low - 0.5)
    width = F.when(high > low, high - low).otherwise(F.lit(1.0)) / bins
    bounds = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    known = df.where(value.isNotNull())
    place = F.least(F.floor((value - start) / width), F.lit(bins - 1)).cast("int")
    counted = (
        known.select(column, bounds.alias("_bounds"))
        .groupBy(place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    spine = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"), bounds.alias("_bounds")
    )
    return spine.join(counted, "bin", "left").select(
        "bin",
        (start + F.col("bin") * width).alias("low"),
        (start + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("_n", F.lit(0)).alias("n"),
    )


def value_counts(df: DataFrame, column: str, size: int) -> DataFrame:
    """Most frequent values, nulls left out; ties in value order."""
    known = df.where(F.col(column).isNotNull())
    counts = known.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(size)


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int = 3) -> DataFrame:
    """Pearson correlation of every pair, over the rows where both are known.

    One aggregate with a few plain sums per pair, so no row is multiplied and no key is
    shuffled; its one row is then turned into cells. A constant column correlates with
    nothing (null); NaN is missing.
    """
    doubles = df.select(*[_known(df, c).cast("double").alias(c) for c in columns])
    pairs = list(combinations_with_replacement(columns, 2))

    def measures(i: int, a: str, b: str) -> list[Column]:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
        return [
            F.covar_samp(x, y).alias(f"_{i}.cov"),
            F.stddev_samp(x).alias(f"_{i}.x"),
            F.stddev_samp(y).alias(f"_{i}.y"),
        ]

    wide = doubles.agg(*[m for i, (a, b) in enumerate(pairs) for m in measures(i, a, b)])

    def cell(i: int, a: str, b: str) -> Column:
        cov, x, y = (F.col(f"`_{i}.{name}`") for name in ("cov", "x", "y"))
        r = F.round(F.try_divide(cov, x * y), digits)
        return F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("r"))

    cells = [cell(i, a, b) for i, (a, b) in enumerate(pairs)]
    cells += [cell(i, b, a) for i, (a, b) in enumerate(pairs) if a != b]
    return wide.select(F.inline(F.array(*cells)))


def score_diagnostics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Min, max, mean, non-zero and zero counts per score, and all rows; NaN is missing."""
    df = df.select(*[_known(df, c).alias(c) for c in columns])
    wanted = {
        "min": F.min,
        "max": F.max,
        "mean": F.avg,
        "non_zero": lambda c: F.count_if(F.col(c) != 0),
        "zero": lambda c: F.count_if(F.col(c) == 0),
        "rows": lambda c: F.count(F.lit(1)),
    }
    wide = df.agg(
        *[build(c).alias(f"{c}.{name}") for c in columns for name, build in wanted.items()]
    )
    casts = wide.select(
        *[
            F.col(f"`{c}.{name}`").cast("double" if name in ("min", "max", "mean") else "long")
            .alias(f"{c}.{name}")
            for c in columns
            for name in wanted
        ]
    )
    return _as_rows(casts, "score", {c: [f"{c}.{name}" for name in wanted] for c in columns})


def filter_funnel(
    df: DataFrame, predicates: dict[str, Column], combined: dict[str, Sequence[str]]
) -> DataFrame:
    """Rows kept and removed by each predicate and each named conjunction, in one pass."""
    steps: dict[str, Column] = {"all rows": F.lit(True), **predicates}
    for name, members in combined.items():
        every = predicates[members[0]]
        for member in members[1:]:
            every = every & predicates[member]
        steps[name] = every
    wide = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(p).alias(f"_{i}") for i, p in enumerate(steps.values())],
    )
    entries = [
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("filter"), F.col(f"_{i}").alias("n"))
        for i, name in enumerate(steps)
    ]
    total = F.col("_total")
    return (
        wide.select("_total", F.inline(F.array(*entries)))
        .withColumn("kept_pct", F.round(F.try_divide(F.col("n") * 100.0, total), 2))
        .withColumn("removed", total - F.col("n"))
        .withColumn("removed_pct", F.round(F.try_divide(F.col("removed") * 100.0, total), 2))
        .drop("_total")
    )


def returns(
    candles: DataFrame,
    ts: str = "Datetime",
    price: str = "Close",
    bucket_seconds: int = DAY_SECONDS,
) -> DataFrame:
    """Add ``return_pct``: unrounded change in percent from the row before."""
    lagged = lag_in_time(candles, ts, price, "_prev", bucket_seconds=bucket_seconds)
    return lagged.withColumn("return_pct", percent_change(price, "_prev")).drop("_prev")


def intervals(df: DataFrame, ts: str, bucket_seconds: int = DAY_SECONDS) -> DataFrame:
    """Add ``gap_seconds``: seconds since the row before, null on the first."""
    stamped = df.withColumn("_at", F.unix_seconds(ts))
    lagged = lag_in_time(stamped, ts, "_at", "_prev", bucket_seconds=bucket_seconds)
    return lagged.withColumn("gap_seconds", F.col("_at") - F.col("_prev")).drop("_at", "_prev")


def interval_profile(df: DataFrame, ts: str) -> DataFrame:
    """Most frequent (the shortest of several), shortest and longest interval."""
    gaps = intervals(df.select(ts), ts).where(F.col("gap_seconds").isNotNull())
    counted = gaps.groupBy("gap_seconds").agg(F.count(F.lit(1)).alias("_n"))
    modal = F.max(F.struct("_n", (-F.col("gap_seconds")).alias("_neg")))
    return counted.agg(
        (-modal.getField("_neg")).alias("most_frequent"),
        F.min("gap_seconds").alias("shortest"),
        F.max("gap_seconds").alias("longest"),
    )


def rolling_mean(
    df: DataFrame,
    ts: str,
    column: str,
    rows: int = 96,
    out: str = "rolling_mean",
    bucket_seconds: int = DAY_SECONDS,
) -> DataFrame:
    """Mean over the last ``rows`` rows, from the first row on."""
    placed = with_position(df, ts, "_position", bucket_seconds=bucket_seconds)
    return rolling_measures(placed, "_position", rows - 1, {out: ("mean", column)}).drop("_position")


def rolling_std(
    df: DataFrame,
    ts: str,
    column: str,
    rows: int = 96,
    at_least: int = 20,
    out: str = "rolling_std",
    bucket_seconds: int = DAY_SECONDS,
) -> DataFrame:
    """Sample std over the last ``rows`` rows; null below ``at_least`` known values."""
    placed = with_position(df, ts, "_position", bucket_seconds=bucket_seconds)
    measures = {"_known": ("count", column), out: ("std", column)}
    spread = rolling_measures(placed, "_position", rows - 1, measures)
    enough = F.when(F.col("_known") >= at_least, F.col(out))
    return spread.withColumn(out, enough).drop("_position", "_known")


def last_distinct_days(df: DataFrame, ts: str, days: int = 10) -> DataFrame:
    """Rows of the last ``days`` calendar days that have any."""
    day = F.to_date(ts).alias("_day")
    latest = df.select(day).where(F.col("_day").isNotNull()).distinct()
    latest = latest.orderBy(F.desc("_day")).limit(days)
    return df.withColumn("_day", F.to_date(ts)).join(latest, "_day", "left_semi").drop("_day")


def top_rows(df: DataFrame, by: str, size: int, tie: Sequence[str] = ()) -> DataFrame:
    """The ``size`` rows with the greatest ``by``."""
    return df.orderBy(F.desc_nulls_last(by), *tie).limit(size)


def head(df: DataFrame, order: Sequence[str], size: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(size)


def tail(df: DataFrame, order: Sequence[str], size: int = 5) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in order]).limit(size)


def one_per(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """First row per key in the given order."""
    return keep_first(df, [key], order)
