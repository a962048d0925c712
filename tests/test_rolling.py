"""Rolling measures in constant work a row, against the plain sliding window."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from offhours.operators.ordered import (
    lag_in_time,
    lead_in_time,
    rolling_measures,
    with_position,
)

KINDS = {k: (k, "v") for k in ("min", "max", "count", "sum", "mean", "std")}
PLAIN = {
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "sum": F.sum,
    "mean": F.avg,
    "std": F.stddev_samp,
}


def numbered(spark, values, keys=("k",)):
    rows = [(k, i, v) for k in keys for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, i long, v double").repartition(5)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("preceding", [0, 1, 4, 30, 200])
def test_equals_the_plain_window(spark, preceding):
    pick = random.Random(preceding)
    values = [None if pick.random() < 0.2 else float(pick.randrange(-9, 9)) for _ in range(130)]
    df = numbered(spark, values, "ab")
    found = rolling_measures(df, "i", preceding, KINDS, ["k"])
    whole = Window.partitionBy("k").orderBy("i").rowsBetween(-preceding, 0)
    wanted = df.withColumns({k: PLAIN[k]("v").over(whole) for k in KINDS})
    assert found.columns == wanted.columns
    for a, b in zip(found.orderBy("k", "i").collect(), wanted.orderBy("k", "i").collect(), strict=True):
        for kind in KINDS:
            if b[kind] is None:
                assert a[kind] is None
            else:
                assert a[kind] == pytest.approx(b[kind], abs=1e-12)


def test_positions_with_gaps_count_as_positions(spark):
    places = [0, 1, 5, 6, 7, 20, 21, 40, 41, 42, 43]
    df = spark.createDataFrame([(p, float(p)) for p in places], "i long, v double")
    found = {r["i"]: r for r in rolling_measures(df, "i", 4, KINDS).collect()}
    for p in places:
        inside = [float(q) for q in places if p - 4 <= q <= p]
        assert (found[p]["min"], found[p]["count"], found[p]["sum"]) == (min(inside), len(inside), sum(inside))


def test_rows_without_a_place_are_kept_and_spread(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") < 10, F.col("id")).alias("i"), F.col("id").cast("double").alias("v")
    )
    found = rolling_measures(df, "i", 2, KINDS)
    assert found.count() == 4000
    assert found.where("i is null and (min is not null or count is not null)").isEmpty()
    assert found.where("i = 9").first()["sum"] == 24.0


def test_nan_and_infinity(spark):
    values = [1.0, math.nan, 2.0, 3.0, math.inf, 4.0, 5.0, 6.0, 7.0]
    rows = rolling_measures(numbered(spark, values), "i", 2, KINDS).orderBy("i").collect()
    assert [math.isnan(r["max"]) for r in rows] == [False, True, True, True] + [False] * 5
    assert [r["min"] for r in rows] == [1.0, 1.0, 1.0, 2.0, 2.0, 3.0, 4.0, 4.0, 5.0]
    assert [math.isnan(r["mean"]) for r in rows[:4]] == [False, True, True, True]
    # Nothing of it is left when it has gone out of the window.
    assert rows[7]["mean"] == 5.0 and rows[8]["std"] == 1.0


def test_deviation_with_a_large_mean_and_after_a_large_value(spark):
    pick = random.Random(1)
    values = [1e9 + pick.random() for _ in range(300)]
    values[50] = 1e15
    rows = rolling_measures(numbered(spark, values), "i", 19, KINDS).orderBy("i").collect()
    for i in range(100, 300):
        inside = values[i - 19 : i + 1]
        assert rows[i]["std"] == pytest.approx(statistics.stdev(inside), rel=1e-6)
        assert rows[i]["mean"] == pytest.approx(statistics.fmean(inside), rel=1e-15)


def test_no_sliding_frame_and_one_shuffle(spark):
    text = plan(rolling_measures(numbered(spark, [1.0]), "i", 672, KINDS, ["k"]))
    assert "672 PRECEDING" not in text and "-672" not in text
    assert text.count("Window [") == 2
    assert text.count("Exchange hashpartitioning") == 1
    assert "currentrow$()" in text and "unboundedfollowing" not in text.lower()


def test_unknown_kinds_are_refused(spark):
    with pytest.raises(ValueError, match="median"):
        rolling_measures(numbered(spark, [1.0]), "i", 2, {"m": ("median", "v")})


def test_rows_without_a_timestamp_are_nobodys_neighbours(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(hours=7 * i), float(i)) for i in range(12)] + [(None, 100.0 + i) for i in range(50)]
    df = spark.createDataFrame(rows, "ts timestamp, v double").repartition(4)
    lagged = lag_in_time(df, "ts", "v", "p").collect()
    led = lead_in_time(df, "ts", ["v"], "n").collect()
    assert len(lagged) == len(led) == 62
    assert all(r["p"] is None for r in lagged if r["ts"] is None or r["v"] == 0.0)
    assert all(r["p"] == r["v"] - 1 for r in lagged if r["ts"] and r["v"] > 0)
    assert all(r["n"] is None for r in led if r["ts"] is None or r["v"] == 11.0)
    assert all(r["n"]["v"] == r["v"] + 1 for r in led if r["ts"] and r["v"] < 11.0)
    assert all((r["i"] is None) == (r["ts"] is None) for r in with_position(df, "ts", "i").collect())


def test_rows_without_a_timestamp_are_no_single_group(spark):
    never = F.when(F.col("id") < 0, F.timestamp_seconds("id"))
    df = spark.range(100).select(never.alias("ts"), F.col("id").alias("v"))
    for build in (
        lambda: lag_in_time(df, "ts", "v", "p"),
        lambda: lead_in_time(df, "ts", ["v"], "n"),
        lambda: with_position(df, "ts", "i"),
    ):
        assert "_loose" in plan(build()).split("Window [")[1]
        assert build().count() == 100
