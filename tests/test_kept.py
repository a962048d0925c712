"""Kept slot scores: pieces equal the whole, and an index reads no event file."""

import datetime as dt
import random

import pytest

from offhours import jobs
from offhours.operators.slots import slot_scores
from offhours.plans import kept
from offhours.schemas import GOLD, SILVER_CANDLES, SILVER_EVENTS, TYPED_CANDLES
from offhours.sources import versions
from offhours.sources.lake import MissingTable, read_table, write_days, write_whole

START = dt.datetime(2026, 2, 1)


def some_events(spark, n, seed):
    pick = random.Random(seed)
    names = SILVER_EVENTS.names
    rows = []
    for i in range(n):
        values = dict.fromkeys(names)
        values["GlobalEventID"] = seed * 1_000_000 + i
        ts = START + dt.timedelta(minutes=15 * pick.randrange(96 * 4))
        values["DATEADDED"] = None if pick.random() < 0.05 else ts
        for c in ("geo_I", "geo_B", "geo_S", "geo_score_raw"):
            values[c] = float(pick.randrange(100))
        values["actor_countries"] = [pick.choice("ABC")]
        rows.append(tuple(values[c] for c in names))
    return spark.createDataFrame(rows, SILVER_EVENTS)


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_pieces_equal_the_whole(spark, tmp_path):
    e, k = str(tmp_path / "events"), str(tmp_path / "slots")
    write_whole(some_events(spark, 300, 1), e, "DATEADDED")
    assert kept.update_slots(spark, e, k) == 4
    assert kept.update_slots(spark, e, k) == 0
    write_days(some_events(spark, 100, 2), e, "DATEADDED", mode="append")
    with pytest.raises(MissingTable, match="lacks 4 folders"):
        kept.kept_slots(spark, e, k)
    assert kept.update_slots(spark, e, k) == 4
    whole = slot_scores(read_table(spark, e, SILVER_EVENTS))
    assert rows_of(kept.kept_slots(spark, e, k)) == rows_of(whole)
    one = kept.kept_slots(spark, e, k, ["2026-02-02"])
    assert rows_of(one) == rows_of(whole.where("to_date(DATEADDED) = '2026-02-02'"))
    assert kept.kept_slots(spark, e, k, ["1999-01-01"]).count() == 0
    # A rebuild of the events leaves nothing of the old ones in the slots.
    write_whole(some_events(spark, 50, 3), e, "DATEADDED")
    kept.update_slots(spark, e, k)
    assert rows_of(kept.kept_slots(spark, e, k)) == rows_of(slot_scores(read_table(spark, e, SILVER_EVENTS)))
    assert kept.forget_slots(spark, e, k) == 0
    versions.vacuum(spark, e, keep=1, in_use=0)
    assert kept.forget_slots(spark, e, k) == 8
    assert rows_of(kept.kept_slots(spark, e, k)) == rows_of(slot_scores(read_table(spark, e, SILVER_EVENTS)))


def test_a_write_that_was_cut_off_is_made_up_for(spark, tmp_path):
    e, k = str(tmp_path / "events"), str(tmp_path / "slots")
    write_whole(some_events(spark, 300, 1), e, "DATEADDED")
    kept.update_slots(spark, e, k)
    lost = sorted(kept._present(spark, k))[0]
    fs, place = versions.hadoop(spark, f"{k}/{lost}")
    fs.delete(place, True)
    assert kept.update_slots(spark, e, k) == 1
    assert rows_of(kept.kept_slots(spark, e, k)) == rows_of(slot_scores(read_table(spark, e, SILVER_EVENTS)))


def test_an_index_from_slots_reads_no_event_file(spark, tmp_path, monkeypatch):
    e, k, c, g, h = (str(tmp_path / n) for n in ("events", "slots", "candles", "gold", "gold2"))
    candles = [
        (START + dt.timedelta(minutes=15 * i), 1.0, 2.0, 0.5, 1.0 + i % 7, 10, 1.5, None)
        for i in range(96 * 4)
        if 30 <= i % 96 < 60
    ]
    write_whole(spark.createDataFrame(candles, SILVER_CANDLES), c, "Datetime")
    write_whole(some_events(spark, 400, 1), e, "DATEADDED")
    assert jobs.index_history(spark, c, e, g, slots=k)
    read = []
    plain = jobs.day_index

    def seen(candles, events, *rest, **more):
        read.extend(events.inputFiles())
        return plain(candles, events, *rest, **more)

    monkeypatch.setattr(jobs, "day_index", seen)
    assert jobs.index_daily(spark, c, e, g, "2026-02-03", slots=k)
    assert read and all("/slots/" in f and "/events/" not in f for f in read)
    assert jobs.index_history(spark, c, e, h)
    assert rows_of(read_table(spark, g, GOLD)) == rows_of(read_table(spark, h, GOLD))


def test_tables_without_versions_are_refused(spark, tmp_path):
    e = str(tmp_path / "events")
    write_days(some_events(spark, 5, 1), e, "DATEADDED")
    with pytest.raises(MissingTable):
        kept.update_slots(spark, e, str(tmp_path / "slots"))


def test_a_stray_old_candle_rewrites_two_days(spark, tmp_path):
    raw, silver = str(tmp_path / "raw"), str(tmp_path / "silver")

    def typed(*days, close=1.0):
        rows = [(START + dt.timedelta(days=d, hours=10 + h), 1.0, 2.0, 0.5, close + h, 10) for d in days for h in range(2)]
        return spark.createDataFrame(rows, TYPED_CANDLES)

    write_days(typed(0, 1, 2, 5, 6, 7, 8), raw, "Datetime")
    assert jobs.candles_history(spark, raw, silver)
    before = versions.current(spark, silver)
    late = typed(3, close=50.0).unionByName(typed(9))
    # Both come with the feed of the ninth day.
    folder = str(tmp_path / "feed")
    late.write.parquet(f"{folder}/date=2026-02-10")
    assert jobs.candles_daily(spark, folder, silver, "2026-02-10")
    after = versions.current(spark, silver)
    changed = {f.rsplit("=", 1)[1] for f in set(after.folders) - set(before.folders)}
    assert changed == {"2026-02-04", "2026-02-06", "2026-02-10"}
    write_days(late, raw, "Datetime")
    whole = str(tmp_path / "whole")
    assert jobs.candles_history(spark, raw, whole)
    assert rows_of(read_table(spark, silver, SILVER_CANDLES)) == rows_of(read_table(spark, whole, SILVER_CANDLES))
