"""Raw candles to clean, enriched candles."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offhours.functions.market import candle_range, percent_change
from offhours.operators.merge import keep_one, upsert_existing_wins
from offhours.operators.ordered import DAY_SECONDS, lag_in_time
from offhours.schemas import SILVER_CANDLES, TYPED_CANDLES, conform

CANDLE_KEY = ["Datetime"]


def flatten_header(df: DataFrame, ticker: str | None = None) -> DataFrame:
    """Drop the ticker level of a two-level header.

    Struct columns (``Close.<ticker>``) and names such as ``('Close', 'X')`` or
    ``Close_X`` come out as ``Close``. Where a field has several tickers,
    ``ticker`` must say which one is meant.
    """
    found: dict[str, dict[str, Column]] = {c: {} for c in TYPED_CANDLES.names}
    for field in df.schema:
        name = re.sub(r"[()']", "", field.name)
        top, _, below = (part.strip() for part in re.sub("[,_]", ",", name, count=1).partition(","))
        top = "Datetime" if top == "index" else top
        if top not in found:
            continue
        column = F.col(f"`{field.name}`")
        if field.dataType.typeName() == "struct":
            found[top].update({t: column.getField(t) for t in field.dataType.names})
        else:
            found[top][below] = column

    def pick(name: str, columns: dict[str, Column]) -> Column:
        if ticker is not None and ticker in columns:
            return columns[ticker].alias(name)
        if len(columns) > 1:
            raise ValueError(f"{name} has several tickers, {sorted(columns)}: name one of them")
        ((only, column),) = columns.items()
        if ticker is not None and only not in ("", ticker):
            raise ValueError(f"{name} has the ticker {only}, not {ticker}")
        return column.alias(name)

    return df.select(*[pick(name, columns) for name, columns in found.items() if columns])


def cast_candles(raw: DataFrame) -> DataFrame:
    """Type the six candle columns; text that does not parse turns null."""
    return conform(raw, TYPED_CANDLES)


def add_range(candles: DataFrame) -> DataFrame:
    return candles.withColumn("Volatility_Range", candle_range())


def add_variation(candles: DataFrame, bucket_seconds: int = DAY_SECONDS) -> DataFrame:
    """Add the change in percent from the close of the candle before."""
    lagged = lag_in_time(candles, "Datetime", "Close", "_prev", bucket_seconds=bucket_seconds)
    change = F.round(percent_change("Close", "_prev"), 4)
    return lagged.withColumn("Variation_Pct", change).drop("_prev")


def clean_candles(
    raw: DataFrame, sort: bool = False, bucket_seconds: int = DAY_SECONDS
) -> DataFrame:
    """Type, de-duplicate and enrich raw candles."""
    unique = keep_one(cast_candles(raw), CANDLE_KEY)
    silver = add_variation(add_range(unique), bucket_seconds).select(*SILVER_CANDLES.names)
    return silver.orderBy("Datetime") if sort else silver


def merge_candles(existing: DataFrame, raw_day: DataFrame) -> DataFrame:
    """Merge newly landed candles; the change in percent runs over the union.

    So the first candle of the new day is compared with the last one before it.
    """
    base = existing.select(*TYPED_CANDLES.names)
    merged = upsert_existing_wins(base, cast_candles(raw_day), CANDLE_KEY)
    return add_variation(add_range(merged)).select(*SILVER_CANDLES.names)
