"""An event feed and a candle feed derived from a generic activity table.

No market or event data ships with this repository. These adapters turn a table
``events(event_id, ts, user_id, event_type, value, props)`` into the two raw
feeds, all by fixed formulas, so that pipelines can run, be checked and be timed
on data of any size. Purchases make the market: a quarter hour that has one is a
candle. All other activity makes the events.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offhours.functions.moments import floor_slot
from offhours.schemas import RAW_EVENT_COLUMNS

# Codes that the formulas pick from.
ACTOR1 = ["SAU", "RUS", "USA", "CHN", "IRN", "XYZ", None, "FRA"]
ACTOR2 = ["USA", None, "IRQ", "GBR", "ZZZ"]
PLACES = ["IZ", "RS", "SA", "US", "CH", "IRQ", None]
ACTOR_TYPES = ["GOV", "MIL", "BUS"]

# First day of the derived feeds, for the date rule of the event filter.
FEED_START = "2024-01-01"


def _pick(options: list[str | None], index: str) -> str:
    items = ", ".join("NULL" if o is None else f"'{o}'" for o in options)
    return f"get(array({items}), CAST({index} AS INT))"


def raw_events(activity: DataFrame) -> DataFrame:
    """Raw events: 61 text columns. Every fiftieth arrives twice."""
    actor1, actor2 = _pick(ACTOR1, "user_id % 8"), _pick(ACTOR2, "event_id % 5")
    values = {
        "GlobalEventID": "event_id",
        "Day": "date_format(slot, 'yyyyMMdd')",
        "MonthYear": "date_format(slot, 'yyyyMM')",
        "Year": "date_format(slot, 'yyyy')",
        "DATEADDED": "date_format(slot, 'yyyyMMddHHmmss')",
        "Actor1Code": f"CASE WHEN event_id % 50 = 7 THEN 'GOVOPC' ELSE {actor1} END",
        "Actor1Name": f"'ACTOR ' || {actor1}",
        "Actor1CountryCode": actor1,
        "Actor1Type1Code": _pick(ACTOR_TYPES, "event_id % 3"),
        "Actor2Code": f"CASE WHEN event_id % 50 = 9 THEN 'GOVOPC' ELSE {actor2} END",
        "Actor2Name": f"'ACTOR ' || {actor2}",
        "Actor2CountryCode": actor2,
        "Actor2Type1Code": _pick(ACTOR_TYPES, "event_id % 2"),
        "IsRootEvent": "event_id % 2",
        "EventCode": "(event_id % 20 + 1) * 10",
        "EventRootCode": "event_id % 20 + 1",
        "QuadClass": "event_id % 4 + 1",
        "GoldsteinScale": "((event_id * 7) % 41 - 20) * 20 / 41",
        "NumMentions": "articles * 3",
        "NumSources": "(articles + 1) / 2",
        "NumArticles": "articles",
        "AvgTone": "CASE WHEN event_id % 97 <> 0 THEN ((event_id * 13) % 201 - 100) * 100 / 397 END",
        "ActionGeo_CountryCode": _pick(PLACES, "event_id % 7"),
        "ActionGeo_Lat": "(event_id % 180 - 90) / 2",
        "ActionGeo_Long": "(event_id % 360 - 180) / 2",
        "SOURCEURL": "'http://news.example/' || event_id",
    }
    return (
        activity.where("event_type <> 'purchase'")
        .withColumn("slot", floor_slot("ts"))
        .selectExpr(
            "event_id",
            "user_id",
            "slot",
            "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 20 + 1 AS articles",
            "explode(sequence(0, CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END)) AS copy",
        )
        .selectExpr(
            *[f"CAST({values.get(c, 'NULL')} AS STRING) AS {c}" for c in RAW_EVENT_COLUMNS]
        )
    )


def raw_candles(activity: DataFrame) -> DataFrame:
    """Raw candles: six text columns. Some arrive twice, some lack a close."""
    trades = activity.where("event_type = 'purchase'").select(
        F.struct("ts", "event_id", "value").alias("trade"), "value", floor_slot("ts").alias("slot")
    )
    bars = trades.groupBy("slot").agg(
        F.min("trade").alias("first"),
        F.max("trade").alias("last"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.count(F.lit(1)).alias("volume"),
    )
    return bars.selectExpr(
        "*",
        "unix_seconds(slot) DIV 900 AS number",
        "explode(sequence(0, CASE WHEN unix_seconds(slot) DIV 900 % 40 = 0 THEN 1 ELSE 0 END)) AS copy",
    ).selectExpr(
        "date_format(slot, 'yyyy-MM-dd HH:mm:ss') AS Datetime",
        "CAST(first.value + copy AS STRING) AS Open",
        "CAST(high + copy AS STRING) AS High",
        "CAST(low + copy AS STRING) AS Low",
        "CAST(CASE WHEN number % 53 <> 0 THEN last.value + copy END AS STRING) AS Close",
        "CAST(volume AS STRING) AS Volume",
    )


def catalogue_lines(activity: DataFrame) -> DataFrame:
    """Catalogue lines: one event export and one mentions file per active slot."""
    slots = activity.select(floor_slot("ts").alias("slot")).distinct()
    stamp = F.date_format("slot", "yyyyMMddHHmmss")
    kind = F.explode(F.array(F.lit("export"), F.lit("mentions"))).alias("kind")
    return slots.select("slot", kind).select(
        F.concat_ws(
            " ",
            (F.unix_seconds("slot") % 9973).cast("string"),
            F.md5(stamp),
            F.concat(F.lit("http://feed.example/v2/"), stamp, F.lit("."), "kind", F.lit(".CSV.zip")),
        ).alias("value")
    )


def packed(raw: DataFrame) -> DataFrame:
    """Raw events as zip archives ``(path, content)``, a bounded batch of rows each."""
    columns = raw.columns

    def pack(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for number, frame in enumerate(frames):
            text = frame[columns].to_csv(sep="\t", header=False, index=False)
            content = io.BytesIO()
            with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("part.export.CSV", text)
            yield pd.DataFrame(
                {"path": [f"batch-{number}.export.CSV.zip"], "content": [content.getvalue()]}
            )

    return raw.mapInPandas(pack, "path string, content binary")


def packed_slots(raw: DataFrame) -> DataFrame:
    """Raw events as the feed delivers them: one zip archive per quarter hour."""

    def zipped(stamp: str, lines: list[str]) -> bytes:
        content = io.BytesIO()
        with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr(f"{stamp}.export.CSV", "\n".join(lines) + "\n")
        return content.getvalue()

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*[c.to_pylist() for c in b.columns]))
        for stamp, some in groupby(rows, key=itemgetter(0)):
            lines = [line for _, line in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"feed/{stamp}.export.CSV.zip"]), pa.array([zipped(stamp, lines)])],
                ["path", "content"],
            )

    # Lines are put together before Python sees them: two columns instead of all.
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in raw.columns])
    lines = raw.select(F.col("DATEADDED").alias("stamp"), line.alias("line"))
    ordered = lines.repartition("stamp").sortWithinPartitions("stamp")
    return ordered.mapInArrow(pack, "path string, content binary")


# Numbers of all kinds, as text.
AWKWARD = ["1.5", "NaN", "Infinity", "-Infinity", "1e39", "bad", "", None]


def awkward_numbers(activity: DataFrame) -> DataFrame:
    """``id``, ``ts``, ``x``, ``y``, ``w``: numbers with missing, NaN, infinite and too large ones.

    ``x`` has all of them, ``y`` and ``w`` NaN only.
    ``ts`` is null on some rows. One row per activity, by fixed formulas.
    """
    x = F.try_element_at(
        F.array(*[F.lit(a) for a in AWKWARD]), (F.col("event_id") % (2 * len(AWKWARD)) + 1).cast("int")
    )
    plain = F.col("value")
    return activity.select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_id") % 11 != 0, F.col("ts").cast("timestamp")).alias("ts"),
        F.when(F.col("event_id") % 16 < len(AWKWARD), x.try_cast("double")).otherwise(plain).alias("x"),
        F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(plain * 2 + F.col("user_id") % 7).alias("y"),
        F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(plain).alias("w"),
    )
