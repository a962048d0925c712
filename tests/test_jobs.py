"""Stored tables: landing, history and daily runs, streaming, documents."""

import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from offhours import jobs, schemas
from offhours.operators.slots import missing_slots, slot_completeness
from offhours.plans.candles import cast_candles, clean_candles
from offhours.plans.events import EventRules, clean_events
from offhours.plans.gold import stress_index
from offhours.plans.landing import expected_exports, land_archives, land_candles
from offhours.sources import exports, feed, lake
from offhours.sources.documents import accounts, write_documents
from offhours.streaming.landed import clean_landed_events

from conftest import at

SF = "/root/testdata/sf0.001"
RULES = EventRules(since=feed.FEED_START)
DAYS = ["2024-01-10", "2024-01-11", "2024-01-12", "2024-01-15"]


@pytest.fixture(scope="module")
def activity(spark):
    return spark.read.parquet(f"{SF}/events.parquet").cache()


def texts(df, *drop):
    return sorted(map(str, df.drop(*drop).collect()))


def rounded(df):
    doubles = [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, 6) for c in doubles})


def land_raw(activity, path, upto=None, day=None):
    raw = feed.raw_events(activity)
    stamped = raw.withColumn("date", F.to_date("DATEADDED", "yyyyMMddHHmmss"))
    if upto:
        stamped = stamped.where(F.col("date") < upto)
    if day:
        stamped = stamped.where(F.col("date") == day)
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def test_daily_runs_give_the_same_tables_as_one_run(spark, activity, tmp_path):
    p = {n: str(tmp_path / n) for n in ["raw", "craw", "events", "candles", "gold"]}
    all_candles = cast_candles(feed.raw_candles(activity))
    land_raw(activity, p["raw"], upto=DAYS[0])
    land_candles(all_candles.where(F.to_date("Datetime") < DAYS[0]), p["craw"])
    assert jobs.events_history(spark, p["raw"], p["events"], RULES)
    assert jobs.candles_history(spark, p["craw"], p["candles"])
    assert jobs.index_history(spark, p["candles"], p["events"], p["gold"])
    for day in DAYS:
        land_raw(activity, p["raw"], day=day)
        land_candles(all_candles.where(F.to_date("Datetime") == day), p["craw"])
        for _ in range(2 if day == DAYS[-1] else 1):  # the last day runs twice
            jobs.events_daily(spark, p["raw"], p["events"], day, RULES)
            jobs.candles_daily(spark, p["craw"], p["candles"], day)
            jobs.index_daily(spark, p["candles"], p["events"], p["gold"], day)

    landed = [F.to_date("DATEADDED", "yyyyMMddHHmmss") < DAYS[0]]
    keep = landed[0] | F.to_date("DATEADDED", "yyyyMMddHHmmss").cast("string").isin(DAYS)
    events = clean_events(feed.raw_events(activity).where(keep), RULES)
    keep = (F.to_date("Datetime") < DAYS[0]) | F.to_date("Datetime").cast("string").isin(DAYS)
    candles = clean_candles(all_candles.where(keep))
    stored = lake.read_table(spark, p["events"], schemas.SILVER_EVENTS)
    assert texts(stored) == texts(events)
    stored = lake.read_table(spark, p["candles"], schemas.SILVER_CANDLES)
    assert texts(stored) == texts(candles)
    stored = lake.read_table(spark, p["gold"], schemas.GOLD)
    assert texts(rounded(stored)) == texts(rounded(stress_index(candles, events)))


def test_backfilled_candles_relink_the_day_after(spark, activity, tmp_path):
    craw, silver = str(tmp_path / "craw"), str(tmp_path / "candles")
    everything = cast_candles(feed.raw_candles(activity))
    land_candles(everything.where(F.to_date("Datetime") != "2024-01-11"), craw)
    jobs.candles_history(spark, craw, silver)
    land_candles(everything.where(F.to_date("Datetime") == "2024-01-11"), craw)
    assert jobs.candles_daily(spark, craw, silver, "2024-01-11")
    stored = lake.read_table(spark, silver, schemas.SILVER_CANDLES)
    assert texts(stored) == texts(clean_candles(everything))


def test_missing_inputs(spark, activity, tmp_path):
    nothing, silver = str(tmp_path / "nothing"), str(tmp_path / "silver")
    assert jobs.events_history(spark, nothing, silver) is False
    assert jobs.candles_history(spark, nothing, silver) is False
    # Without a clean table a daily run builds one from all that landed.
    assert jobs.events_daily(spark, nothing, silver, "2024-01-10") is False
    raw = str(tmp_path / "raw")
    land_raw(activity, raw, upto=DAYS[0])
    jobs.events_history(spark, raw, silver, RULES)
    before = texts(lake.read_table(spark, silver, schemas.SILVER_EVENTS))
    assert jobs.events_daily(spark, raw, silver, "2030-01-01", RULES) is False
    assert texts(lake.read_table(spark, silver, schemas.SILVER_EVENTS)) == before


def test_a_table_can_replace_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(at("2024-01-01 00:00:00"), 1.0), (at("2024-01-02 00:00:00"), 2.0)]
    df = spark.createDataFrame(rows, "Datetime timestamp, v double")
    lake.write_whole(df, path, "Datetime")
    stored = lake.read_table(spark, path, df.schema)
    lake.write_whole(stored.where("v > 1").withColumn("v", F.col("v") * 10), path, "Datetime")
    spark.catalog.refreshByPath(path)
    assert [r.v for r in lake.read_table(spark, path, df.schema).collect()] == [20.0]


def test_day_reads_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(dt.datetime(2024, 1, d), float(d)) for d in range(1, 6)]
    df = spark.createDataFrame(rows, "Datetime timestamp, v double")
    lake.write_days(df, path, "Datetime")
    day = lake.read_day(spark, path, df.schema, "2024-01-03")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert [r.v for r in day.collect()] == [3.0]
    two = lake.read_days(spark, path, df.schema, ["2024-01-01", "2024-01-05"])
    assert sorted(r.v for r in two.collect()) == [1.0, 5.0]
    assert lake.read_folders(spark, path, df.schema).count() == 5
    with pytest.raises(FileNotFoundError):
        lake.read_folders(spark, str(tmp_path / "none"))


def test_stream_takes_in_what_landed(spark, activity, tmp_path):
    raw, silver, state = (str(tmp_path / n) for n in ["raw", "silver", "state"])
    land_raw(activity, raw, upto=DAYS[0])

    def run():
        query = clean_landed_events(spark, raw, silver, state, RULES, files_per_batch=5)
        query.awaitTermination()

    run()
    land_raw(activity, raw, day=DAYS[0])
    run()
    run()  # nothing new
    until = F.to_date("DATEADDED", "yyyyMMddHHmmss") <= DAYS[0]
    expected = clean_events(feed.raw_events(activity).where(until), RULES)
    stored = lake.read_table(spark, silver, schemas.SILVER_EVENTS)
    assert texts(stored) == texts(expected)


def zipped(path, name, lines):
    with zipfile.ZipFile(path, "w") as archive:
        for member, text in {name: lines}.items():
            archive.writestr(member, text)


def line(**values):
    return "\t".join(values.get(c, "") for c in schemas.RAW_EVENT_COLUMNS)


def test_archives_and_tsv(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    first = line(GlobalEventID="1", Actor1Name="JANE \"\"DOE", Day="20260227", Actor2Code="NA")
    second = line(GlobalEventID="2", Day="20260227", AvgTone="nan")
    zipped(folder / "20260227093000.export.CSV.zip", "20260227093000.export.CSV", f"{first}\n{second}\n")
    zipped(folder / "20260228000000.export.CSV.zip", "20260228000000.export.CSV", "")
    zipped(folder / "20260227093000.mentions.CSV.zip", "x.CSV", "not\tevents\n")
    rows = exports.read_archives(spark, str(folder), "*.export.CSV.zip").orderBy("GlobalEventID")
    one, two = rows.collect()
    assert one.member == "20260227093000.export.CSV"
    assert (one.GlobalEventID, one.Day, one.Actor2Code, one.SOURCEURL) == ("1", "20260227", None, None)
    assert two.AvgTone is None

    (tmp_path / "plain.CSV").write_text(f"{line(GlobalEventID='1', Actor2Code='NA')}\n{second}\n")
    one, two = exports.read_tsv(spark, str(tmp_path / "plain.CSV")).orderBy("GlobalEventID").collect()
    assert (one.GlobalEventID, one.Actor2Code, two.AvgTone) == ("1", None, None)

    raw = str(tmp_path / "raw")
    land_archives(spark, str(folder), raw)
    land_archives(spark, str(folder), raw)
    assert lake.read_day(spark, raw, schemas.RAW_EVENTS, "2026-02-27").count() == 2
    assert lake.read_day(spark, raw, schemas.RAW_EVENTS, "2026-02-28") is None


def test_broken_archive_raises(spark, tmp_path):
    (tmp_path / "x.zip").write_bytes(b"no archive")
    with pytest.raises(Exception, match="zip"):
        exports.read_archives(spark, str(tmp_path)).collect()


def test_packed_archives_round_trip(spark, activity):
    raw = feed.raw_events(activity)
    back = exports.unpack_archives(feed.packed(raw)).drop("archive", "member")
    assert texts(back) == texts(raw)


def test_catalogue(spark, tmp_path):
    base = "http://feed.example/v2"
    lines = [
        f"100 a {base}/20260104000000.export.CSV.zip",
        f"100 b {base}/20260104001500.mentions.CSV.zip",
        f"100 c {base}/20260103234500.export.CSV.zip",
        f"100 d {base}/20260104003000.export.CSV.zip",
        f"100 e {base}/notadate.export.CSV.zip",
        "short",
        "",
    ]
    (tmp_path / "list.txt").write_text("\n".join(lines) + "\n")
    found = expected_exports(spark, str(tmp_path / "list.txt"), "2026-01-04").collect()
    assert [(r.size, r.hash, r.slot) for r in found] == [
        ("100", "a", at("2026-01-04 00:00:00")),
        ("100", "d", at("2026-01-04 00:30:00")),
    ]


def test_completeness(spark):
    stamps = [dt.datetime(2026, 2, 27) + dt.timedelta(minutes=15 * i) for i in range(96)]
    landed = spark.createDataFrame([(t,) for t in stamps if t.hour != 5], "t timestamp")
    days = spark.createDataFrame([(dt.date(2026, 2, 27),), (dt.date(2026, 2, 28),)], "day date")
    report = {str(r.day): tuple(r)[1:] for r in slot_completeness(landed, days, "t").collect()}
    assert report == {"2026-02-27": (96, 92, 4), "2026-02-28": (96, 0, 96)}
    gone = missing_slots(landed, days.limit(1), "t").orderBy("slot").collect()
    assert [r.slot.hour for r in gone] == [5] * 4


def gold_rows(spark):
    names = schemas.GOLD.names
    base = {n: 1.0 for n in names}
    base.update(Datetime=at("2026-02-16 00:00:00"), Volume=10, gap_duration_15m=5)
    base.update(period_actor_country="USA", Variation_Pct=float("nan"), High=float("inf"))
    other = {**base, "Datetime": at("2026-02-16 00:15:00"), "period_actor_country": None}
    broken = {**base, "Datetime": None}
    return spark.createDataFrame(
        [tuple(r[n] for n in names) for r in (base, other, broken)], schemas.GOLD
    )


def test_documents_are_written_and_counted(spark, tmp_path):
    gold = gold_rows(spark)
    assert tuple(accounts(gold).first()) == (2, 1)
    account = write_documents(gold, str(tmp_path / "docs"), str(tmp_path / "rejects"))
    assert (account.success, account.errors, len(account.examples)) == (2, 1, 1)
    docs = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "docs")).collect()]
    bodies = [json.loads(d["_source"]) for d in docs]
    assert {b["timestamp"] for b in bodies} == {"2026-02-16T00:00:00Z", "2026-02-16T00:15:00Z"}
    for body in bodies:
        assert len(body) == 20 and "geo_score_raw_max" not in body and "Datetime" not in body
        assert body["Variation_Pct"] is None and body["High"] is None and body["Volume"] == 10
    assert len({d["_id"] for d in docs}) == 2
    none = write_documents(gold.limit(0), str(tmp_path / "none"))
    assert (none.success, none.errors) == (0, 0)
    again = write_documents(gold, str(tmp_path / "again"))
    ids = {json.loads(r.value)["_id"] for r in spark.read.text(str(tmp_path / "again")).collect()}
    assert again.success == 2 and ids == {d["_id"] for d in docs}


def test_command_line(monkeypatch):
    called = []
    monkeypatch.setattr(jobs, "build_session", lambda name: name)
    for name in ("events_history", "events_daily", "candles_daily", "index_daily", "serve"):
        monkeypatch.setattr(jobs, name, lambda *a, name=name: called.append((name, a)))
    with pytest.raises(SystemExit):
        jobs.main(["events", "--mode", "daily", "--raw", "r", "--silver", "s"])
    jobs.main(["events", "--mode", "history", "--raw", "r", "--silver", "s"])
    jobs.main(["candles", "--mode", "daily", "--date", "2026-02-27", "--raw", "r", "--silver", "s"])
    jobs.main(["index", "--mode", "daily", "--date", "2026-02-27", "--candles", "c", "--events", "e",
               "--gold", "g"])
    jobs.main(["serve", "--gold", "g", "--documents", "d"])
    assert [c[0] for c in called] == ["events_history", "candles_daily", "index_daily", "serve"]
    assert called[1][1][1:] == ("r", "s", "2026-02-27")
