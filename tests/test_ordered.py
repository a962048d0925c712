"""The distributed ordered operators against the plain, unpartitioned windows."""

import datetime as dt
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from offhours.operators.ordered import (
    fill_between,
    lag_in_time,
    lead_in_time,
    next_open,
    rolling,
    with_position,
)
from offhours.operators.ranking import centred_ranks, counted_order, exact_quantiles

START = dt.datetime(2024, 1, 1)
slow = settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def series(spark, slots_and_values):
    rows = [(START + dt.timedelta(minutes=15 * s), v) for s, v in sorted(slots_and_values.items())]
    return spark.createDataFrame(rows, "ts timestamp, v double").repartition(3)


some_series = st.dictionaries(
    st.integers(0, 96 * 9), st.one_of(st.none(), st.integers(0, 5).map(float)), min_size=1, max_size=60
)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@slow
@given(some_series, st.sampled_from([86_400, 3_600]))
def test_lag_lead_and_position(spark, data, width):
    df = series(spark, data)
    whole = Window.orderBy("ts")
    lagged = lag_in_time(df, "ts", "v", "p", bucket_seconds=width).select("ts", "p")
    assert same(lagged, df.select("ts", F.lag("v").over(whole).alias("p")))
    led = lead_in_time(df, "ts", ["v"], "n", bucket_seconds=width).select("ts", "n.ts", "n.v").toDF("ts", "a", "b")
    plain = df.select("ts", F.lead("ts").over(whole).alias("a"), F.lead("v").over(whole).alias("b"))
    assert same(led, plain)
    placed = with_position(df, "ts", "i", bucket_seconds=width).select("ts", "i")
    plain = df.select("ts", (F.row_number().over(whole) - 1).cast("long").alias("i"))
    assert same(placed, plain)


@slow
@given(some_series, st.integers(1, 7), st.integers(0, 9))
def test_rolling(spark, data, preceding, extra):
    df = with_position(series(spark, data), "ts", "i")
    build = {
        "low": lambda w: F.min("v").over(w),
        "high": lambda w: F.max("v").over(w),
        "n": lambda w: F.count(F.lit(1)).over(w),
    }
    got = rolling(df, "i", preceding, build, bucket_rows=preceding + extra)
    whole = Window.orderBy("ts").rowsBetween(-preceding, 0)
    assert same(got, df.withColumns({k: f(whole) for k, f in build.items()}))


@slow
@given(some_series, st.sampled_from([86_400, 3_600]))
def test_next_open(spark, data, width):
    df = series(spark, data).withColumn("market_open", F.col("v").isNotNull().cast("int"))
    opens = df.where("market_open = 1").select(F.col("ts").alias("Datetime"))
    got = next_open(df, opens, ts="ts", out="t", bucket_seconds=width).select("ts", "t")
    back = Window.orderBy(F.col("ts").desc()).rowsBetween(Window.unboundedPreceding, 0)
    target = F.last(F.when(F.col("market_open") == 1, F.col("ts")), ignorenulls=True).over(back)
    assert same(got, df.select("ts", target.alias("t")))


def test_rolling_needs_buckets_as_long_as_the_window(spark):
    with pytest.raises(ValueError):
        rolling(spark.range(3), "id", 5, {}, bucket_rows=4)


@pytest.mark.parametrize("linear", [False, True])
def test_fill_between(spark, linear):
    df = series(spark, {0: 1.0, 4: 3.0, 200: 5.0})
    rows = fill_between(df, "ts", ["v"], 900, linear=linear).orderBy("ts").collect()
    assert len(rows) == 201
    assert [r.filled for r in rows[:5]] == [False, True, True, True, False]
    assert [r.v for r in rows[:5]] == ([1.0, 1.5, 2.0, 2.5, 3.0] if linear else [1.0, None, None, None, 3.0])
    assert rows[-1].v == 5.0 and rows[-1].ts == START + dt.timedelta(minutes=3000)


def test_keys_are_kept_apart(spark):
    rows = [(k, START + dt.timedelta(days=d), float(d)) for k in "ab" for d in range(3)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    got = lag_in_time(df, "ts", "v", "p", ["k"]).orderBy("k", "ts").collect()
    assert [r.p for r in got] == [None, 0.0, 1.0] * 2
    filled = fill_between(df, "ts", ["v"], 43_200, ["k"], linear=True)
    assert filled.groupBy("k").count().orderBy("k").collect() == [("a", 5), ("b", 5)]


def test_ranks_match_brute_force_with_a_heavy_tie(spark):
    rng = random.Random(5)
    values = [0.0] * 400 + [float(rng.randrange(-50, 50)) for _ in range(800)]
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(6)
    ordered = sorted(values)
    for r in counted_order(df, [], "v").collect():
        assert r.n == ordered.count(r.v)
        assert r.n_below == ordered.index(r.v)
        assert r.n_total == len(values)
    ranks = {r.v: r.x for r in centred_ranks(df, [], "v", "x").collect()}
    middle = (len(values) + 1) / 2
    for v in set(values):
        places = [i + 1 for i, x in enumerate(ordered) if x == v]
        assert ranks[v] == sum(places) / len(places) - middle


def test_quantiles_match_brute_force(spark):
    rng = random.Random(9)
    groups = {"a": [rng.random() for _ in range(101)], "b": [1.0], "c": [float(i) for i in range(8)]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("c", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    wanted = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    for r in exact_quantiles(df, ["g"], "v", wanted).collect():
        vs = sorted(groups[r.g])
        for name, q in wanted.items():
            place = q * (len(vs) - 1)
            lo, hi = math.floor(place), math.ceil(place)
            expected = vs[lo] + (vs[hi] - vs[lo]) * (place - lo)
            assert r[name] == pytest.approx(expected)
