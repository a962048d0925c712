"""Stored data survives what goes wrong; no row is dropped on the way."""

import datetime as dt
import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from offhours import jobs
from offhours.operators.merge import new_only, replace_day
from offhours.operators.ordered import with_position
from offhours.operators.profile import column_stats, correlation_matrix, histogram, rolling_mean
from offhours.plans.candles import flatten_header
from offhours.plans.events import EventRules
from offhours.plans.landing import land_archives, land_rows
from offhours.plans.serving import average_auto, to_documents
from offhours.schemas import GOLD, RAW_EVENT_COLUMNS, RAW_EVENTS, SILVER_CANDLES
from offhours.sources import feed
from offhours.sources.documents import accounts
from offhours.sources.exports import read_tsv
from offhours.sources.lake import EmptyResult, MissingTable, has_files, read_folders, read_table, write_whole


def candle(spark, *days):
    rows = [(dt.datetime(2026, 2, d), 1.0, 2.0, 0.5, 1.5, 10, 1.5, None) for d in days]
    return spark.createDataFrame(rows, SILVER_CANDLES)


def test_an_empty_folder_is_missing(spark, tmp_path):
    os.makedirs(tmp_path / "empty" / "_temporary")
    (tmp_path / "empty" / "_SUCCESS").write_text("")
    folder = str(tmp_path / "empty")
    assert not has_files(spark, folder) and not has_files(spark, str(tmp_path / "none"))
    for path in (folder, str(tmp_path / "none")):
        with pytest.raises(MissingTable):
            read_table(spark, path, SILVER_CANDLES)
        with pytest.raises(MissingTable):
            read_folders(spark, path, SILVER_CANDLES)
        with pytest.raises(MissingTable):
            jobs.serve(spark, path, str(tmp_path / "documents"))
    assert not (tmp_path / "documents").exists()


def test_a_rebuild_without_rows_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "silver")
    write_whole(candle(spark, 1, 2), path, "Datetime")
    with pytest.raises(EmptyResult):
        write_whole(candle(spark, 1).limit(0), path, "Datetime")
    assert not jobs.candles_history(spark, str(tmp_path / "nothing"), path)
    assert read_table(spark, path, SILVER_CANDLES).count() == 2
    assert os.listdir(tmp_path) == ["silver"]


def test_a_swap_that_was_cut_off_is_put_right(spark, tmp_path):
    path = str(tmp_path / "silver")
    write_whole(candle(spark, 1, 2), path, "Datetime")
    os.rename(path, path + "__old")  # as a crash between the two renames leaves it
    assert read_table(spark, path, SILVER_CANDLES).count() == 2
    os.rename(path, path + "__old")
    write_whole(candle(spark, 3), path, "Datetime")
    spark.catalog.refreshByPath(path)
    assert read_table(spark, path, SILVER_CANDLES).count() == 1
    os.makedirs(path + "__old/left")  # an old copy that was not deleted is no obstacle
    write_whole(candle(spark, 4, 5), path, "Datetime")
    spark.catalog.refreshByPath(path)
    assert read_table(spark, path, SILVER_CANDLES).count() == 2


def export_line(event_id):
    return "\t".join([str(event_id), *["x"] * (len(RAW_EVENT_COLUMNS) - 1)]) + "\n"


def put_archive(folder, name, *ids):
    os.makedirs(folder, exist_ok=True)
    with zipfile.ZipFile(f"{folder}/{name}", "w") as archive:
        archive.writestr(name.replace(".zip", ""), "".join(map(export_line, ids)))


def landed(spark, raw):
    return sorted(r[0] for r in read_table(spark, raw, RAW_EVENTS).select(RAW_EVENT_COLUMNS[0]).collect())


def test_archives_land_one_at_a_time(spark, tmp_path):
    raw = str(tmp_path / "raw")
    assert not land_archives(spark, str(tmp_path / "nowhere"), raw)
    put_archive(tmp_path / "a", "20260227090000.export.CSV.zip", 1)
    put_archive(tmp_path / "b", "20260227091500.export.CSV.zip", 2, 3)
    put_archive(tmp_path / "c", "odd.export.CSV.zip", 4)
    put_archive(tmp_path / "d", "odder.export.CSV.zip", 5)
    for folder in "abcd":
        land_archives(spark, str(tmp_path / folder), raw)
    assert landed(spark, raw) == ["1", "2", "3", "4", "5"]
    put_archive(tmp_path / "b", "20260227091500.export.CSV.zip", 7)  # comes again, changed
    put_archive(tmp_path / "b", "20260228000000.export.CSV.zip", 8)
    jobs.land(spark, str(tmp_path / "b"), raw, "2026-02-27")
    assert landed(spark, raw) == ["1", "4", "5", "7"]
    jobs.land(spark, str(tmp_path / "b"), raw)
    assert landed(spark, raw) == ["1", "4", "5", "7", "8"]


def test_archives_and_plain_files_are_parsed_alike(spark, tmp_path):
    lines = ["1\tNULL\t\"a\"\"b\"\t\n", "\n", "2\tonly two\n", "3" + "\tx" * 80 + "\n"]
    os.makedirs(tmp_path / "zip")
    (tmp_path / "plain.csv").write_text("".join(lines))
    with zipfile.ZipFile(tmp_path / "zip" / "20260227090000.export.CSV.zip", "w") as archive:
        archive.writestr("x.CSV", "".join(lines))
    raw = str(tmp_path / "raw")
    land_archives(spark, str(tmp_path / "zip"), raw)
    plain = read_tsv(spark, str(tmp_path / "plain.csv")).collect()
    assert sorted(map(str, read_table(spark, raw, RAW_EVENTS).collect())) == sorted(map(str, plain))


def test_landing_again_takes_as_many_jobs_for_more_days(spark, tmp_path):
    def rows(archives):
        named = spark.createDataFrame([(a, a) for a in archives], "GlobalEventID string, archive string")
        blank = [F.lit(None).cast("string").alias(c) for c in RAW_EVENTS.names[1:]]
        return named.select("GlobalEventID", *blank, F.concat(F.lit("/x/"), "archive").alias("archive"))

    def jobs_of(days):
        raw = str(tmp_path / f"raw{days}")
        names = [f"202402{d + 1:02}00{m}00.export.CSV.zip" for d in range(days) for m in ("00", "15")]
        land_rows(rows(names), raw)
        spark.sparkContext.setJobGroup(raw, raw)
        # Of each day's folder one archive comes again, of the last day's both.
        land_rows(rows(names[::2] + names[-1:]), raw)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert landed(spark, raw) == sorted(names)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(raw))

    assert jobs_of(9) <= jobs_of(2) + 3


def test_slots_are_packed_from_whole_lines(spark):
    raw = spark.createDataFrame(
        [("1", "20240101000000", None), ("2", "20240101001500", "a b"), ("3", "20240101000000", "c")],
        "GlobalEventID string, DATEADDED string, SOURCEURL string",
    )
    found = feed.packed_slots(raw)
    texts = {}
    for r in found.collect():
        with zipfile.ZipFile(io.BytesIO(r.content)) as archive:
            texts[r.path] = sorted(archive.read(archive.namelist()[0]).decode().splitlines(keepends=True))
    assert texts == {
        "feed/20240101000000.export.CSV.zip": ["1\t20240101000000\t\n", "3\t20240101000000\tc\n"],
        "feed/20240101001500.export.CSV.zip": ["2\t20240101001500\ta b\n"],
    }
    # Python gets two columns, however many there are.
    assert found._jdf.queryExecution().analyzed().child().output().size() == 2


def test_since_is_a_date():
    assert EventRules(since="2026-1").since == dt.date(2026, 1, 1)
    assert EventRules(since="2026-1-9").since == dt.date(2026, 1, 9)
    assert EventRules(since=dt.datetime(2026, 1, 9, 5)).since == dt.date(2026, 1, 9)
    for bad in ("soon", "20260101", "2026-13-1", ""):
        with pytest.raises(ValueError):
            EventRules(since=bad)


def test_tickers_are_named_or_refused(spark):
    df = spark.createDataFrame([("t", 1.0, 2.0)], "Datetime string, `('Close', 'A')` double, `('Close', 'B')` double")
    assert flatten_header(df, "B").first()["Close"] == 2.0
    with pytest.raises(ValueError):
        flatten_header(df)
    with pytest.raises(ValueError):
        flatten_header(df.drop("('Close', 'B')"), "B")


def test_rows_without_a_timestamp_stay(spark):
    rows = [(dt.datetime(2026, 2, 27, h), float(h)) for h in range(5)] + [(None, 9.0), (None, None)]
    df = spark.createDataFrame(rows, "ts timestamp, x double")
    found = rolling_mean(df, "ts", "x", 3).collect()
    assert len(found) == 7 and all(r["rolling_mean"] is None for r in found if r["ts"] is None)
    assert sorted(r["_pos"] for r in with_position(df, "ts").collect() if r["ts"]) == list(range(5))
    kept = replace_day(df, df.limit(0), "ts", "2026-02-27")
    assert kept.count() == 2


def test_the_bucket_limit_holds_on_any_span(spark):
    days = spark.range(400).select(F.timestamp_seconds(F.col("id") * 86_400 + 1234).alias("t"), F.col("id").alias("x"))
    for most in (100, 7, 2):
        found = average_auto(days, ["x"], most, "t")
        assert found.count() <= most and found.first()["interval_seconds"] % 86_400 == 0


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (float("nan"), 1.0), (3.0, float("nan"))], "x double, y double")
    stats = column_stats(df, "x").first()
    assert (stats["min"], stats["max"], stats["mean"], stats["median"]) == (1.0, 3.0, 2.0, 2.0)
    assert sum(r["n"] for r in histogram(df, "x", 4).collect()) == 3
    assert {r["r"] for r in correlation_matrix(df, ["x", "y"]).collect()} == {1.0}


def test_infinity_is_not_served(spark):
    row = {f.name: None for f in GOLD} | {"Datetime": dt.datetime(2026, 2, 27)}
    closes = [1.5, 1e39, float("inf"), float("nan"), None]
    gold = spark.createDataFrame([tuple((row | {"Close": c}).values()) for c in closes], GOLD)
    assert [r["Close"] for r in to_documents(gold).collect()] == [1.5, None, None, None, None]
    assert tuple(accounts(gold).first()) == (4, 1)


def test_new_keys_are_sought_within_their_range(spark, tmp_path):
    path = str(tmp_path / "old")
    spark.range(1000).selectExpr("id", "id AS v").write.parquet(path)
    new = spark.range(990, 1010).selectExpr("id", "-id AS v")
    found = new_only(spark.read.parquet(path), new, ["id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,990)" in plan and "LessThanOrEqual(id,1009)" in plan
    assert "Range (" not in plan  # what is new was computed once
    assert sorted(r["id"] for r in found.collect()) == list(range(1000, 1010))


def test_correlations_take_one_pass(spark):
    df = spark.range(10).selectExpr("double(id) AS a", "double(id * id) AS b", "double(-id) AS c")
    plan = correlation_matrix(df, ["a", "b", "c"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("HashAggregate")  # only the result row is spread
    assert "hashpartitioning" not in plan
