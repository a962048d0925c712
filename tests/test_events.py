import datetime as dt

import pytest
from pyspark.sql import functions as F

from offhours.functions import geo
from offhours.plans.events import (
    EventRules,
    cast_events,
    clean_events,
    daily_events,
    merge_events,
)
from offhours.schemas import RAW_EVENTS, SILVER_EVENTS

DEFAULT = {
    "GlobalEventID": "1234567890",
    "Day": "20260227",
    "DATEADDED": "20260227093000",
    "Actor1Code": "USA",
    "Actor1Name": "UNITED STATES",
    "Actor1CountryCode": "USA",
    "Actor1Type1Code": "GOV",
    "Actor2Code": "RUS",
    "Actor2Name": "RUSSIA",
    "Actor2CountryCode": "RUS",
    "Actor2Type1Code": "GOV",
    "EventCode": "190",
    "EventRootCode": "19",
    "QuadClass": "4",
    "IsRootEvent": "1",
    "GoldsteinScale": "-10.0",
    "AvgTone": "-5.5",
    "ActionGeo_CountryCode": "IRQ",
    "ActionGeo_Lat": "33.0",
    "ActionGeo_Long": "44.0",
    "NumMentions": "50",
    "NumSources": "20",
    "NumArticles": "15",
}


def raw(spark, *overrides):
    rows = []
    for override in overrides:
        row = {**DEFAULT, **override}
        rows.append(tuple(row.get(c) for c in RAW_EVENTS.names))
    return spark.createDataFrame(rows, RAW_EVENTS)


def test_clean_has_the_declared_schema(spark):
    df = clean_events(raw(spark, {}))
    assert df.schema.simpleString() == SILVER_EVENTS.simpleString()
    row = df.first()
    assert row.GlobalEventID == 1234567890
    assert row.Day == dt.date(2026, 2, 27)
    assert row.DATEADDED == dt.datetime(2026, 2, 27, 9, 30)
    assert row.EventCode == 190 and row.AvgTone == -5.5


def test_bad_text_turns_null(spark):
    df = cast_events(raw(spark, {c: "val" for c in DEFAULT}))
    row = df.first()
    for name in ("GlobalEventID", "Day", "DATEADDED", "QuadClass", "AvgTone", "ActionGeo_Lat"):
        assert row[name] is None
    assert row.Actor1Code == "val"


@pytest.mark.parametrize(
    "text, expected",
    [("4", 4), ("4.0", 4), ("4.7", 4), (" 12 ", 12), ("-3", -3), ("4.x", None), ("", None),
     ("99999999999", None), (None, None)],
)
def test_whole_numbers(spark, text, expected):
    assert cast_events(raw(spark, {"NumArticles": text})).first().NumArticles == expected


@pytest.mark.parametrize(
    "override",
    [
        {"NumArticles": "2"},
        {"GoldsteinScale": "-2.0"},
        {"QuadClass": "1"},
        {"EventRootCode": "4"},
        {"Day": "20251231"},
        {"Day": None},
        {"NumArticles": None},
        {"GoldsteinScale": "x"},
    ],
)
def test_minor_events_are_dropped(spark, override):
    df = clean_events(raw(spark, {"GlobalEventID": "1"}, {"GlobalEventID": "2", **override}))
    assert [r.GlobalEventID for r in df.collect()] == [1]


def test_early_date_test_keeps_whatever_the_date_rule_keeps(spark):
    days = ["20260101", "20251231", "+120260101", "-20260101", "19990101", "20260227"]
    df = raw(spark, *[{"GlobalEventID": str(i), "Day": d} for i, d in enumerate(days)])
    rules = EventRules()
    exact = cast_events(df).where(rules.major()).select("GlobalEventID").collect()
    both = cast_events(df.where(rules.possible())).where(rules.major())
    assert sorted(both.select("GlobalEventID").collect()) == sorted(exact)
    assert {r[0] for r in exact} == {0, 2, 5}


def test_copies_collapse_and_the_passing_one_is_kept(spark):
    same = raw(spark, {}, {}, {})
    assert clean_events(same).count() == 1
    mixed = raw(spark, {"NumArticles": "2"}, {"NumArticles": "9"}, {"NumArticles": "7"})
    assert [r.NumArticles for r in clean_events(mixed).collect()] == [7]


def test_dedup_does_not_depend_on_partitioning(spark):
    rows = [{"GlobalEventID": str(i % 5), "NumMentions": str(i)} for i in range(40)]
    df = raw(spark, *rows)
    one = clean_events(df.coalesce(1)).select("GlobalEventID", "NumMentions").collect()
    many = clean_events(df.repartition(7)).select("GlobalEventID", "NumMentions").collect()
    assert sorted(one) == sorted(many)


def scalar(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column).first()[0]


@pytest.mark.parametrize(
    "code, weight", [("USA", 4), ("IRN", 6), ("NGA", 3), ("CHN", 2), ("ZZZ", 1), (None, 1)]
)
def test_country_weight(spark, code, weight):
    df = spark.createDataFrame([(code,)], "c string")
    assert df.select(geo.country_weight("c")).first()[0] == weight


def test_fips_weights_follow_the_iso_ones(spark):
    df = spark.createDataFrame([("IZ",), ("RS",), ("UK",), ("IRQ",)], "c string")
    weights = df.select(geo.country_weight("c", geo.FIPS2_WEIGHT)).collect()
    assert [w[0] for w in weights] == [6, 6, 2, 1]
    assert len(geo.FIPS2_TO_ISO3) == len(geo.ISO3_WEIGHT) == 27


@pytest.mark.parametrize(
    "value, expected",
    [(0.5, 0.5), (-0.3, 0.0), (1.5, 1.0), (0.0, 0.0), (1.0, 1.0), (None, 1.0), (float("nan"), 1.0)],
)
def test_clip(spark, value, expected):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(geo.clip01(F.col("x"))).first()[0] == expected


def test_scores(spark):
    row = clean_events(raw(spark, {"ActionGeo_CountryCode": "IZ"})).first()
    importance = 6 + 0.5 * ((4 + 6 + 6 - 6) - 2)
    assert row.geo_I == importance
    assert row.geo_B == pytest.approx(2.772588722)
    assert row.geo_S == pytest.approx(1 + 1.5 + 0.055)
    assert row.geo_score_raw == pytest.approx(importance**2 * row.geo_B * row.geo_S)


def test_missing_tone_counts_as_hostile_unless_told_otherwise(spark):
    df = raw(spark, {"AvgTone": None})
    assert clean_events(df).first().geo_S == pytest.approx(3.5)
    assert clean_events(df, EventRules(null_tone=0.0)).first().geo_S == pytest.approx(2.5)


@pytest.mark.parametrize(
    "place, actor1, actor2, expected",
    [
        ("IZ", "USA", "RUS", ["IRQ", "USA", "RUS"]),
        ("IZ", "IRQ", "IRQ", ["IRQ"]),
        ("IRQ", "USA", None, ["USA"]),
        (None, "XYZ", "RS", ["XYZ", "RUS"]),
        (None, None, None, []),
    ],
)
def test_involved_countries(spark, place, actor1, actor2, expected):
    df = spark.createDataFrame([(place, actor1, actor2)], "p string, a string, b string")
    assert df.select(geo.involved_countries("p", "a", "b")).first()[0] == expected


def test_existing_events_win(spark):
    old = clean_events(raw(spark, {"GlobalEventID": "1", "NumMentions": "900"}))
    new = raw(spark, {"GlobalEventID": "1", "NumMentions": "1"}, {"GlobalEventID": "2"})
    merged = daily_events(old, new)
    assert {(r.GlobalEventID, r.NumMentions) for r in merged.collect()} == {(1, 900), (2, 50)}
    again = merge_events(merged, clean_events(new))
    assert sorted(again.select("GlobalEventID", "NumMentions").collect()) == sorted(
        merged.select("GlobalEventID", "NumMentions").collect()
    )


def test_union_is_strict(spark):
    old = clean_events(raw(spark, {}))
    with pytest.raises(Exception):
        merge_events(old, old.drop("AvgTone")).collect()


def test_filter_runs_before_the_shuffle_and_reaches_the_scan(spark, tmp_path):
    raw(spark, {}).write.parquet(str(tmp_path / "raw"))
    df = clean_events(spark.read.schema(RAW_EVENTS).parquet(str(tmp_path / "raw")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("Filter") < plan.index("FileScan")
    assert "GreaterThanOrEqual(Day,20260101)" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    scan = plan[plan.index("ReadSchema"):]
    assert "SOURCEURL" not in scan
