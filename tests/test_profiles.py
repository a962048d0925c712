import math

import pytest
from pyspark.sql import functions as F

from offhours.functions.significance import two_sided_p
from offhours.operators import profile
from offhours.plans import calibration, profiles, serving
from offhours.plans.candles import clean_candles
from offhours.plans.events import EventRules, cast_events
from offhours.plans.gold import stress_index
from offhours.schemas import DOCUMENTS, GOLD
from offhours.sources import feed
from offhours.plans.events import clean_events

from conftest import at

SF = "/root/testdata/sf0.01"
RULES = EventRules(since=feed.FEED_START)


@pytest.fixture(scope="module")
def layers(spark):
    activity = spark.read.parquet(f"{SF}/events.parquet")
    raw = feed.raw_events(activity)
    candles = clean_candles(feed.raw_candles(activity)).cache()
    gold = stress_index(candles, clean_events(raw, RULES)).cache()
    return candles, cast_events(raw).cache(), gold


def test_every_profile_runs(layers):
    candles, events, gold = layers
    for frames in (
        profiles.profile_candles(candles),
        profiles.profile_events(events, RULES),
        profiles.profile_gold(gold),
    ):
        for name, df in frames.items():
            assert df.count() > 0, name


def test_describe_matches_pandas(layers):
    candles, _, _ = layers
    numbers = ["Open", "Close", "Volume", "Variation_Pct"]
    expected = candles.select(*numbers).toPandas().astype(float).describe()
    for r in profile.describe(candles, numbers).collect():
        for ours, theirs in {"count": "count", "mean": "mean", "std": "std", "min": "min",
                             "p25": "25%", "p50": "50%", "p75": "75%", "max": "max"}.items():
            assert r[ours] == pytest.approx(expected[r["column"]][theirs]), (r["column"], ours)


def test_histogram_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0, 1, 5, 10]] + [(None,)], "v double")
    rows = profile.histogram(df, "v", 5).orderBy("bin").collect()
    assert [r.n for r in rows] == [3, 0, 1, 0, 1]
    assert (rows[0].low, rows[-1].high) == (0.0, 10.0)
    single = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    rows = profile.histogram(single, "v", 4).orderBy("bin").collect()
    assert [r.n for r in rows] == [0, 0, 2, 0] and rows[0].low == 1.5


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c"), (2, "d")], "k int, v string"
    )
    assert tuple(profile.duplicate_counts(df, ["k"]).first()) == (6, 2, 3)


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x"), (4, "y")], "a int, b string")
    rows = {r["column"]: (r.missing, r.total_missing_pct) for r in profile.null_profile(df).collect()}
    assert rows == {"a": (1, 37.5), "b": (2, 37.5)}


def test_funnel_names_both_totals(layers):
    _, events, _ = layers
    rows = {r["filter"]: r for r in profiles.event_funnel(events, RULES).collect()}
    assert len(rows) == 13
    assert rows["all rows"].n == events.count()
    assert rows["all filters"].n >= rows["all with root codes"].n
    assert rows["all with root codes"].n == events.where(RULES.major()).count()
    for r in rows.values():
        assert r.n + r.removed == rows["all rows"].n


def test_correlation_ignores_rows_with_a_null(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 1.0), (2.0, 4.0, 1.0), (3.0, None, 1.0), (4.0, 8.0, 1.0)],
        "x double, y double, z double",
    )
    cells = {(r.a, r.b): r.r for r in profile.correlation_matrix(df, ["x", "y", "z"]).collect()}
    assert cells["x", "y"] == cells["y", "x"] == 1.0
    assert cells["x", "x"] == 1.0 and cells["z", "z"] is None
    assert len(cells) == 9


def test_last_days_are_days_with_rows(spark):
    times = ["2024-01-01 10:00:00", "2024-01-05 10:00:00", "2024-01-05 11:00:00", "2024-01-09 10:00:00"]
    df = spark.createDataFrame([(at(t),) for t in times], "t timestamp")
    kept = profile.last_distinct_days(df, "t", 2).orderBy("t").collect()
    assert [str(r.t) for r in kept] == times[1:]


@pytest.mark.parametrize(
    "t, freedom, p",
    # Textbook values of the t distribution.
    [(12.706204736, 1, 0.05), (2.228138852, 10, 0.05), (1.959963985, 1e9, 0.05), (0.0, 7, 1.0),
     (3.169272673, 10, 0.01), (-2.228138852, 10, 0.05), (float("inf"), 5, 0.0)],
)
def test_p_values(t, freedom, p):
    assert two_sided_p(t, freedom) == pytest.approx(p, rel=1e-6, abs=1e-12)


def average_ranks(values):
    ordered = sorted(values)
    return [ordered.index(v) + (ordered.count(v) + 1) / 2 for v in values]


def spearman(a, b):
    x, y = average_ranks(a), average_ranks(b)
    mx, my = sum(x) / len(x), sum(y) / len(y)
    cov = sum((i - mx) * (j - my) for i, j in zip(x, y))
    return cov / math.sqrt(sum((i - mx) ** 2 for i in x) * sum((j - my) ** 2 for j in y))


def small_gold(spark):
    rows = []
    for i in range(60):
        gap = 1 + i % 3
        peak = 0.0 if i % 4 == 0 else float((i * 7) % 13)
        change = None if i == 5 else float((i * 11) % 17 - 8)
        for country in ["USA", "RUS"][: 1 + i % 2]:
            rows.append((at(f"2024-01-01 {i // 4:02d}:{i % 4 * 15:02d}:00"), gap, peak,
                         peak * 0.6 * gap, change, country))
    return spark.createDataFrame(
        rows,
        "Datetime timestamp, gap_duration_15m bigint, geo_score_raw_max double,"
        " geo_score_raw_sum double, Variation_Pct double, period_actor_country string",
    )


@pytest.mark.parametrize("dedup, absolute", [(True, False), (False, False), (True, True)])
def test_grid_matches_brute_force(spark, dedup, absolute):
    gold = small_gold(spark)
    rows = [r for r in gold.collect() if r.gap_duration_15m > 1 and r.Variation_Pct is not None]
    if dedup:
        rows = list({r.Datetime: r for r in rows}.values())
    change = [abs(r.Variation_Pct) if absolute else r.Variation_Pct for r in rows]
    grid = calibration.alpha_grid(gold, dedup=dedup, absolute=absolute)
    result = calibration.with_significance(grid).orderBy("alpha").collect()
    assert [r.alpha for r in result] == [round(i * 0.05, 4) for i in range(21)]
    for r in result:
        score = [
            r.alpha * g.geo_score_raw_max
            + (1 - r.alpha) * (g.geo_score_raw_sum / g.gap_duration_15m)
            for g in rows
        ]
        assert r.n == len(rows)
        assert r.spearman_rho == pytest.approx(spearman(score, change), abs=1e-9)
        t = r.spearman_rho * math.sqrt((r.n - 2) / (1 - r.spearman_rho**2))
        assert r.p_value == pytest.approx(two_sided_p(t, r.n - 2))
    best = calibration.calibrate_alpha(grid).first()
    top = max(result, key=lambda r: (r.abs_rho, -r.alpha))
    assert (best.alpha, best.spearman_rho) == (top.alpha, pytest.approx(top.spearman_rho))
    assert best.gain == pytest.approx(top.abs_rho - result[16].abs_rho)
    assert calibration.best_alphas(grid).count() == 5


def test_no_best_alpha_without_reopenings(layers):
    _, _, gold = layers
    grid = calibration.alpha_grid(gold.where("gap_duration_15m = 1"))
    assert calibration.calibrate_alpha(grid).collect() == calibration.best_alphas(grid).collect() == []


def test_document_types_and_missing_columns(layers):
    _, _, gold = layers
    assert gold.schema.simpleString() == GOLD.simpleString()
    documents = serving.to_documents(gold)
    assert documents.schema.simpleString() == DOCUMENTS.simpleString()
    fewer = gold.drop("score_pct_7d")
    assert "score_pct_7d" not in serving.to_documents(fewer).columns
    assert serving.absent_columns(fewer) == ["score_pct_7d"]
    with pytest.raises(ValueError, match="Datetime"):
        serving.to_documents(gold.drop("Datetime"))


def test_timestamps_with_an_offset_become_utc(spark):
    df = spark.createDataFrame([("2026-02-16T02:00:00+02:00",), ("2026-02-16 00:00:00",)], "Datetime string")
    assert {r.timestamp for r in serving.to_documents(df).collect()} == {"2026-02-16T00:00:00Z"}


def test_auto_interval(spark):
    def width(hours):
        rows = [(at("2024-01-01 00:00:00"), 1.0)]
        times = spark.createDataFrame(rows, "Datetime timestamp, v double")
        end = times.select(F.expr(f"Datetime + interval {hours} hours").alias("Datetime"), "v")
        return serving.average_auto(times.union(end), ["v"]).first().interval_seconds

    assert [width(h) for h in (20, 24, 90, 200, 1000, 5000)] == [
        900, 900, 3600, 10_800, 43_200, 3 * 86_400
    ]


def test_country_dimension_keeps_countries_without_rows(spark, layers):
    _, _, gold = layers
    codes = spark.createDataFrame([("USA",), ("QQQ",)], "iso3 string")
    counts = {r.iso3: r.n for r in serving.country_counts(codes, gold).collect()}
    assert counts["USA"] > 0 and counts["QQQ"] is None


def test_recent_rows(spark):
    df = spark.createDataFrame([(at("2024-01-01 00:00:00"),), (at("2024-06-01 00:00:00"),)], "t timestamp")
    assert serving.last_days(df, "t", 90, "2024-06-02").count() == 1
    assert serving.last_days(df, "t", 90).count() == 0
