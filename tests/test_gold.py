import pytest
from pyspark.sql import functions as F

from offhours.operators import slots
from offhours.operators.merge import replace_day
from offhours.plans import gold
from offhours.schemas import GOLD, SCORE_COLUMNS, SILVER_CANDLES

from conftest import at

SCORED = "DATEADDED timestamp, geo_I double, geo_B double, geo_S double, geo_score_raw double," \
    " actor_countries array<string>"
SLOTS = "DATEADDED timestamp, geo_I double, geo_B double, geo_S double, geo_score_raw double," \
    " event_count bigint, actor_countries array<string>"


def scored(spark, *rows):
    return spark.createDataFrame([(at(t) if t else None, *rest) for t, *rest in rows], SCORED)


def candles(spark, *times, close=100.0):
    rows = [(at(t), 1.0, 2.0, 0.5, close, 10, 1.5, None) for t in times]
    return spark.createDataFrame(rows, SILVER_CANDLES)


def test_slot_sums_and_counts(spark):
    df = scored(
        spark,
        ("2026-02-27 09:00:00", 1.0, 2.0, 1.5, 10.0, ["USA"]),
        ("2026-02-27 09:00:00", 2.0, 1.0, 2.0, 8.0, ["RUS"]),
        ("2026-02-27 09:15:00", 3.0, 3.0, 3.0, 20.0, ["CHN"]),
        (None, 9.0, 9.0, 9.0, 90.0, ["IRN"]),
    )
    first, second = slots.slot_scores(df).orderBy("DATEADDED").collect()
    assert (first.geo_I, first.geo_B, first.event_count) == (3.0, 3.0, 2)
    assert first.actor_countries == ["USA"]
    assert second.event_count == 1


def test_worst_event_names_the_countries_and_ties_are_settled(spark):
    t = "2026-02-27 09:00:00"
    df = scored(spark, (t, 1.0, 1.0, 1.0, 10.0, ["USA"]), (t, 1.0, 1.0, 1.0, 50.0, ["RUS", "IRN"]))
    assert slots.slot_scores(df).first().actor_countries == ["RUS", "IRN"]
    tied = scored(spark, (t, 1.0, 1.0, 1.0, 5.0, ["USA"]), (t, 1.0, 1.0, 1.0, 5.0, ["USA", "IRN"]))
    assert slots.slot_scores(tied).first().actor_countries == ["USA", "IRN"]


def test_off_grid_events_can_be_floored(spark):
    df = scored(
        spark,
        ("2026-02-27 09:03:10", 1.0, 1.0, 1.0, 1.0, ["USA"]),
        ("2026-02-27 09:14:59", 1.0, 1.0, 1.0, 2.0, ["USA"]),
    )
    assert slots.slot_scores(df).count() == 2
    assert slots.slot_scores(df, floor=True).first().DATEADDED == at("2026-02-27 09:00:00")


def test_timeline_flags_open_rows_and_fills_scores(spark):
    empty = spark.createDataFrame([], SLOTS)
    row = slots.join_timeline(candles(spark, "2026-02-27 09:00:00"), empty).first()
    assert row.market_open == 1
    assert [row[c] for c in SCORE_COLUMNS] == [0.0] * 4 and row.event_count == 0.0
    assert row.actor_countries == []

    two = spark.createDataFrame(
        [(at("2026-02-27 09:00:00"), 1.0, 1.0, 1.0, 1.0, 1, ["USA"]),
         (at("2026-02-27 03:00:00"), 1.0, 1.0, 1.0, 1.0, 1, ["USA"])],
        SLOTS,
    )
    timeline = slots.join_timeline(candles(spark, "2026-02-27 09:00:00"), two)
    flags = {r.master_datetime.hour: r.market_open for r in timeline.collect()}
    assert flags == {9: 1, 3: 0}
    assert dict(timeline.dtypes)["event_count"] == "double"
    assert slots.open_closed_counts(timeline).first() == (2, 1, 1)


def test_closed_rows_roll_forward_and_trailing_ones_drop(spark):
    slot_times = ["2026-02-27 03:00:00", "2026-02-27 03:15:00", "2026-02-27 23:00:00",
                  "2026-02-20 10:00:00", "2026-03-03 23:00:00"]
    s = spark.createDataFrame([(at(t), 1.0, 1.0, 1.0, 1.0, 1, ["USA"]) for t in slot_times], SLOTS)
    c = candles(spark, "2026-02-27 09:00:00", "2026-03-02 01:00:00")
    target = {
        r.master_datetime: r.target_open_datetime for r in gold.assign_periods(c, s).collect()
    }
    nine, monday = at("2026-02-27 09:00:00"), at("2026-03-02 01:00:00")
    assert target == {
        at("2026-02-20 10:00:00"): nine,
        at("2026-02-27 03:00:00"): nine,
        at("2026-02-27 03:15:00"): nine,
        nine: nine,
        at("2026-02-27 23:00:00"): monday,
        monday: monday,
    }


def test_candle_without_close_counts_as_closed(spark):
    c = candles(spark, "2026-02-27 09:15:00").unionByName(
        candles(spark, "2026-02-27 09:00:00", close=None)
    )
    empty = spark.createDataFrame([], SLOTS)
    rows = gold.assign_periods(c, empty).collect()
    assert {r.target_open_datetime for r in rows} == {at("2026-02-27 09:15:00")}
    assert len(rows) == 2


def to_smooth(spark, *scores):
    rows = [(at("2026-02-27 09:00:00"), s, s, s, s, 1.0, ["USA"]) for s in scores]
    return spark.createDataFrame(
        rows,
        "target_open_datetime timestamp, geo_I double, geo_B double, geo_S double,"
        " geo_score_raw double, event_count double, actor_countries array<string>",
    )


def test_hybrid_smoothing(spark):
    row = slots.smooth_periods(to_smooth(spark, 10.0, 20.0)).first()
    assert row.geo_score_raw_smoothed == 16.25
    assert (row.geo_score_raw_sum, row.geo_score_raw_max) == (30.0, 20.0)
    assert slots.smooth_periods(to_smooth(spark, 10.0, 20.0), alpha=1.0).first()[
        "geo_score_raw_smoothed"
    ] == 20.0


def test_gap_counts_rows(spark):
    row = slots.smooth_periods(to_smooth(spark, 1.0, 2.0, 3.0)).first()
    assert row.gap_duration_15m == 3 and row.total_event_count == 3.0


def many(spark, days=6, per_day=20):
    """Weekday candles, round-the-clock events, some of both missing."""
    c, e = [], []
    base = at("2024-01-01 00:00:00")
    import datetime as dt

    for d in range(days):
        for i in range(96):
            t = base + dt.timedelta(days=d, minutes=15 * i)
            if (base + dt.timedelta(days=d)).weekday() < 5 and 20 <= i < 20 + per_day and i % 7:
                c.append((t, 1.0, 2.0, 0.5, 100.0 + (d * 7 + i) % 11, 10, 1.5, None))
            if (d * 96 + i) % 3 == 0:
                score = float((d * 31 + i * 17) % 23)
                e.append((t, score, score / 2, 1.0, score * 3, ["USA", "RUS"][: 1 + i % 2]))
    return (
        spark.createDataFrame(c, SILVER_CANDLES).repartition(3),
        spark.createDataFrame(e, SCORED).repartition(3),
    )


def test_index_schema_and_countries(spark):
    c, e = many(spark, days=2)
    df = gold.stress_index(c, e, sort=True)
    assert df.schema.simpleString() == GOLD.simpleString()
    rows = df.collect()
    assert [r.Datetime for r in rows] == sorted(r.Datetime for r in rows)
    lonely = gold.stress_index(c, e.limit(0)).collect()
    assert {r.period_actor_country for r in lonely} == {None}
    assert {r.score_pct_7d for r in lonely} == {50.0}
    assert len(lonely) == c.count()


def test_rolling_score_values(spark):
    c, e = many(spark)
    rules = gold.GoldRules(window_rows=9)
    rows = gold.candle_scores(c, e, rules).orderBy("Datetime").collect()
    scores = [r.geo_score_raw_smoothed for r in rows]
    for i, r in enumerate(rows):
        window = scores[max(0, i - 9): i + 1]
        low, high = min(window), max(window)
        expected = 50.0 if low == high else round((scores[i] - low) / (high - low) * 100, 2)
        assert r.score_pct_7d == pytest.approx(expected, abs=0.011)


@pytest.mark.parametrize("window_rows", [5, 40, 672])
def test_day_by_day_equals_everything_at_once(spark, window_rows):
    c, e = many(spark, days=9)
    rules = gold.GoldRules(window_rows=window_rows)
    full = gold.stress_index(c, e, rules)
    table = full.limit(0)
    for day in ["2024-01-03", "2024-01-05", "2024-01-08", "2024-01-09"]:
        expected = full.where(F.to_date("Datetime") == day)
        got = gold.day_index(c, e, day, rules)
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
        table = replace_day(table, got, "Datetime", day)
    again = replace_day(table, gold.day_index(c, e, "2024-01-05", rules), "Datetime", "2024-01-05")
    assert sorted(map(str, again.collect())) == sorted(map(str, table.collect()))


def test_calendar_context_is_available(spark):
    c, e = many(spark, days=9)
    rows = gold.day_index(c, e, "2024-01-08", context_days=8)
    assert {r.Datetime.date().isoformat() for r in rows.collect()} == {"2024-01-08"}


def test_replace_day_fills_missing_columns(spark):
    old = candles(spark, "2026-02-26 09:00:00", "2026-02-27 09:00:00").withColumn("x", F.lit(1))
    new = candles(spark, "2026-02-27 10:00:00")
    rows = replace_day(old, new, "Datetime", "2026-02-27").orderBy("Datetime").collect()
    assert [(r.Datetime.hour, r.x) for r in rows] == [(9, 1), (10, None)]
