import pytest

from offhours.functions.market import candle_direction
from offhours.plans.candles import clean_candles, flatten_header, merge_candles
from offhours.schemas import RAW_CANDLES, SILVER_CANDLES
from pyspark.sql import functions as F

from conftest import at

FIRST = ("2026-02-27 09:30:00", "62.90", "62.95", "62.85", "100.00", "120")
SECOND = ("2026-02-27 09:45:00", "62.95", "63.00", "62.90", "101.00", "95")


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_CANDLES)


def rows(df):
    return df.orderBy("Datetime").collect()


def test_types_and_schema(spark):
    df = clean_candles(raw(spark, FIRST))
    assert df.schema.simpleString() == SILVER_CANDLES.simpleString()
    row = df.first()
    assert (row.Datetime, row.Close, row.Volume) == (at("2026-02-27 09:30:00"), 100.0, 120)


def test_bad_text_turns_null(spark):
    row = clean_candles(raw(spark, ("2026-02-27 09:30:00", "x", "", "1", "?", "y"))).first()
    assert (row.Open, row.High, row.Low, row.Close, row.Volume) == (None, None, 1.0, None, None)


def test_duplicates_keep_one(spark):
    assert clean_candles(raw(spark, FIRST, FIRST, SECOND)).count() == 2


def test_range_and_variation(spark):
    first, second = rows(clean_candles(raw(spark, SECOND, FIRST)))
    assert first.Volatility_Range == pytest.approx(0.1)
    assert first.Variation_Pct is None
    assert second.Variation_Pct == 1.0


def test_sorted_output(spark):
    times = [r.Datetime for r in clean_candles(raw(spark, SECOND, FIRST), sort=True).collect()]
    assert times == sorted(times)


def test_variation_crosses_days_and_skips_none(spark):
    data = [
        ("2026-02-27 21:45:00", "1", "1", "1", "100", "1"),
        ("2026-03-02 01:00:00", "1", "1", "1", "110", "1"),
        ("2026-03-02 01:15:00", "1", "1", "1", None, "1"),
        ("2026-03-02 01:30:00", "1", "1", "1", "0", "1"),
        ("2026-03-03 01:00:00", "1", "1", "1", "5", "1"),
    ]
    changes = [r.Variation_Pct for r in rows(clean_candles(raw(spark, *data)))]
    # After a missing or a zero close there is nothing to compare with.
    assert changes == [None, 10.0, None, None, None]


def test_merge_compares_with_the_day_before(spark):
    existing = clean_candles(raw(spark, FIRST))
    new = [
        ("2026-02-27 09:30:00", "0", "0", "0", "1", "1"),  # exists already
        ("2026-02-28 09:30:00", "1", "2", "1", "150", "1"),
    ]
    first, second = rows(merge_candles(existing, raw(spark, *new)))
    assert first.Close == 100.0
    assert second.Variation_Pct == 50.0
    again = merge_candles(merge_candles(existing, raw(spark, *new)), raw(spark, *new))
    assert rows(again) == [first, second]


def test_two_level_header(spark):
    df = spark.createDataFrame(
        [("2026-02-27 09:30:00", (1.0,), 2.0, 3.0, 4.0, 5)],
        "Datetime string, Close struct<T: double>, `('High', 'T')` double, Low_T double,"
        " Open double, `('Volume', 'T')` bigint",
    )
    flat = flatten_header(df)
    assert flat.columns == ["Datetime", "Open", "High", "Low", "Close", "Volume"]
    assert tuple(flat.first())[1:] == (4.0, 2.0, 3.0, 1.0, 5)


def test_direction(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (1.0, 2.0)], "Open double, Close double")
    assert [r[0] for r in df.select(candle_direction()).collect()] == ["up", "down", "up"]


def test_no_window_over_the_whole_series(spark):
    df = clean_candles(raw(spark, FIRST, SECOND)).where(F.col("Close") > 0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            # The one table brought together is the per-day summary.
            assert "key=[_day" in lines[i + 1] or "keys=[_day" in lines[i + 1]
