"""Further registered queries: awkward values, stored tables, and whole jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.queries import (
    CANDLE_SQL,
    DAY,
    DOCUMENT_SQL,
    FLOATS,
    GOLD_SQL,
    RULES,
    SILVER_SQL,
    TYPED_SQL,
    query,
)
from offhours import jobs
from offhours.operators import profile
from offhours.plans import candles, events, gold, serving
from offhours.plans.events import EventRules
from offhours.plans.landing import land_listed, land_rows, ledger
from offhours.schemas import DOCUMENTS, GOLD, RAW_EVENTS, SILVER_CANDLES, SILVER_EVENTS
from offhours.session import fresh_folder, materialize
from offhours.sources import documents, exports, feed, lake, versions

# --- values as real feeds have them ---------------------------------------------------

SINCE = ["2024-1-20", "2024-1", "2024"]
SINCE_DAY = ["2024-01-20", "2024-01-01", "2024-01-01"]


@query(
    "events_since_forms",
    " UNION ALL ".join(
        f"SELECT '{form}' AS since, GlobalEventID FROM silver_events WHERE Day >= DATE '{day}'"
        for form, day in zip(SINCE, SINCE_DAY)
    ),
)
def _(layers):
    parts = [
        events.clean_events(layers.raw_events, EventRules(since=form)).select(
            F.lit(form).alias("since"), "GlobalEventID"
        )
        for form in SINCE
    ]
    return parts[0].union(parts[1]).union(parts[2])


@query("flat_header_two_tickers", "SELECT Datetime, Open, High, Low, Close, Volume FROM typed_candles")
def _(layers):
    two = layers.raw_candles.select(
        "Datetime",
        *[F.struct(F.lit("1").alias("OTHER"), F.col(c).alias("MINE")).alias(c) for c in ("Open", "High")],
        *[F.col(c).alias(f"('{c}', 'MINE')") for c in ("Low", "Close", "Volume")],
        *[F.lit("1").alias(f"('{c}', 'OTHER')") for c in ("Low", "Close", "Volume")],
    )
    return candles.cast_candles(candles.flatten_header(two, "MINE"))


SMALL_AUTO = """
span AS (SELECT CAST(epoch(min(Datetime)) AS BIGINT) AS a, CAST(epoch(max(Datetime)) AS BIGINT) AS b
         FROM silver_candles),
width AS (SELECT coalesce((SELECT min(w) FROM unnest([900, 3600, 10800, 43200, 86400]) AS t(w)
                           WHERE b // w - a // w + 1 <= 10),
                          CAST(ceil((b - a + 1) / (86400.0 * 9)) AS BIGINT) * 86400) AS w FROM span)"""


@query(
    "hist_avg_auto_small",
    """SELECT make_timestamp((CAST(epoch(Datetime) AS BIGINT) // w) * w * 1000000) AS bucket,
              CAST(w AS INTEGER) AS interval_seconds, round(avg(Volume), 6) AS Volume
       FROM silver_candles, width GROUP BY 1, 2""",
    extra=SMALL_AUTO,
    digits=6,
)
def _(layers):
    return serving.average_auto(layers.candles, ["Volume"], max_buckets=10)


@query(
    "rolling_mean_null_ts",
    """SELECT Datetime, Close, round(avg(Close) OVER (ORDER BY Datetime ROWS 95 PRECEDING), 9)
              AS rolling_mean FROM silver_candles
       UNION ALL SELECT NULL, Close, NULL FROM silver_candles WHERE minute(Datetime) = 0""",
    digits=9,
)
def _(layers):
    rows = layers.candles.select("Datetime", "Close")
    lost = rows.where(F.minute("Datetime") == 0).withColumn("Datetime", F.lit(None).cast("timestamp"))
    return profile.rolling_mean(rows.union(lost), "Datetime", "Close")


AWKWARD_SQL = """
awkward AS (SELECT CASE WHEN event_id % 5 <> 0 THEN value * 2 + user_id % 7 END AS y,
                   CASE WHEN event_id % 7 <> 0 THEN value END AS w FROM events)"""


@query(
    "column_stats_nan",
    """SELECT round(min(y), 6) AS min, round(max(y), 6) AS max, round(avg(y), 6) AS mean,
              round(stddev_samp(y), 6) AS std, round(max(y) - min(y), 6) AS "range",
              round(quantile_cont(y, 0.5), 6) AS median FROM awkward""",
    extra=AWKWARD_SQL,
    digits=6,
)
def _(layers):
    return profile.column_stats(feed.awkward_numbers(layers.activity), "y")


@query(
    "histogram_nan",
    """SELECT bin, round(lo + bin * wd, 6) AS low, round(lo + (bin + 1) * wd, 6) AS high,
              coalesce(n, 0) AS n
       FROM (SELECT CAST(unnest(range(20)) AS INTEGER) AS bin) CROSS JOIN bounds
       LEFT JOIN (SELECT CAST(least(floor((y - lo) / wd), 19) AS INTEGER) AS bin, count(*) AS n
                  FROM awkward, bounds WHERE y IS NOT NULL GROUP BY 1) USING (bin)""",
    extra=AWKWARD_SQL + ", bounds AS (SELECT min(y) AS lo, (max(y) - min(y)) / 20 AS wd FROM awkward)",
    digits=6,
)
def _(layers):
    return profile.histogram(feed.awkward_numbers(layers.activity), "y", 20)


@query(
    "corr_matrix_nan",
    """SELECT a, b, round(r, 3) AS r FROM (
         SELECT 'y' AS a, 'w' AS b, corr(y, w) AS r FROM awkward
         UNION ALL SELECT 'w', 'y', corr(y, w) FROM awkward
         UNION ALL SELECT 'y', 'y', 1.0 UNION ALL SELECT 'w', 'w', 1.0)""",
    extra=AWKWARD_SQL,
)
def _(layers):
    return profile.correlation_matrix(feed.awkward_numbers(layers.activity), ["y", "w"])


@query(
    "score_diagnostics_nan",
    """SELECT 'y' AS score, round(min(y), 6) AS min, round(max(y), 6) AS max, round(avg(y), 6) AS mean,
              count(*) FILTER (y <> 0) AS non_zero, count(*) FILTER (y = 0) AS zero,
              count(*) AS "rows" FROM awkward""",
    extra=AWKWARD_SQL,
    digits=6,
)
def _(layers):
    return profile.score_diagnostics(feed.awkward_numbers(layers.activity), ["y"])


def spoiled(index: DataFrame) -> DataFrame:
    """The index with NaN, infinities, too large numbers and lost timestamps."""
    number = F.unix_seconds("Datetime") / 900
    kind = (number % 5).cast("int")
    close = (
        F.when(kind == 0, F.lit(float("nan")))
        .when(kind == 1, F.lit(float("-inf")))
        .when(kind == 2, F.lit(1e39))
        .otherwise(F.col("Close"))
    )
    lost = (number % 7).cast("int") == 0
    return index.withColumns(
        {"Close": close, "Datetime": F.when(~lost, F.col("Datetime"))}
    )


NUMBERED = "numbered AS (SELECT *, CAST(epoch(Datetime) AS BIGINT) // 900 AS number FROM gold)"


@query(
    "serve_non_finite",
    """SELECT CASE WHEN number % 7 <> 0 THEN strftime(Datetime, '%Y-%m-%dT%H:%M:%SZ') END AS "timestamp",
              CASE WHEN number % 5 > 2 THEN round(CAST(Close AS FLOAT)::DOUBLE, 2) END AS Close,
              period_actor_country FROM numbered""",
    extra=NUMBERED,
)
def _(layers):
    typed = serving.to_documents(spoiled(layers.gold))
    return typed.select("timestamp", F.round(F.col("Close").cast("double"), 2).alias("Close"), "period_actor_country")


@query(
    "write_refused",
    """SELECT count(*) FILTER (number % 7 <> 0 AND number % 5 <> 2) AS success,
              count(*) FILTER (number % 7 = 0 OR number % 5 = 2) AS errors FROM numbered""",
    extra=NUMBERED,
)
def _(layers):
    return documents.accounts(spoiled(layers.gold))


@query("document_sink_fields", DOCUMENT_SQL)
def _(layers):
    path = fresh_folder(layers.spark, "documents")
    documents.write_documents(layers.gold, path)
    lines = layers.spark.read.text(path).select(
        F.from_json("value", "_id string, _source string").alias("d")
    )
    parsed = lines.select("d._id", F.from_json("d._source", DOCUMENTS).alias("s")).select("_id", "s.*")
    return parsed.select(
        "_id", "timestamp", "Volume", "gap_duration_15m", "period_actor_country",
        *[F.round(F.col(c).cast("double"), 2).alias(c) for c in FLOATS],
    )


@query("gold_hour_buckets", f"{GOLD_SQL} FROM gold", digits=6)
def _(layers):
    """The index with all ordered steps inside hours instead of days."""
    return gold.stress_index(layers.candles, layers.events, gold.GoldRules(bucket_seconds=3600))


@query(
    "ordered_hour_buckets",
    """SELECT Datetime, Close, Variation_Pct,
              round(avg(Close) OVER (ORDER BY Datetime ROWS 9 PRECEDING), 9) AS rolling_mean
       FROM silver_candles""",
    digits=9,
)
def _(layers):
    rows = candles.clean_candles(layers.raw_candles, bucket_seconds=3600)
    means = profile.rolling_mean(rows, "Datetime", "Close", 10, bucket_seconds=3600)
    return means.select("Datetime", "Close", "Variation_Pct", "rolling_mean")


# --- stored tables --------------------------------------------------------------------


def land_events(layers, raw: DataFrame | None = None) -> str:
    """The raw events as a landed table."""
    raw = layers.raw_events if raw is None else raw
    path = fresh_folder(layers.spark, "raw")
    day = F.to_date("DATEADDED", "yyyyMMddHHmmss")
    raw.withColumn(lake.DAY, day).write.partitionBy(lake.DAY).parquet(path)
    return path


def empty_folder(layers) -> str:
    path = fresh_folder(layers.spark, "empty")
    fs, place = lake._hadoop(layers.spark, path)
    fs.mkdirs(place)
    return path


@query("land_slots", f"SELECT {TYPED_SQL} FROM typed_events")
def _(layers):
    """Each day lands in two parts, one of them twice."""
    path = fresh_folder(layers.spark, "raw")
    archives = materialize(feed.packed_slots(layers.raw_events))
    part = F.crc32(F.col("path").cast("binary")) % 2
    for number in (0, 1, 0):
        land_rows(exports.unpack_archives(archives.where(part == number)), path)
    return events.cast_events(lake.read_table(layers.spark, path, RAW_EVENTS))


def landed_in_turns(layers) -> str:
    """One part of the archives lands, then all are offered twice, a broken one among them."""
    path = fresh_folder(layers.spark, "raw")
    packed = feed.packed_slots(layers.raw_events).select("path", "content")
    broken = layers.spark.createDataFrame(
        [("feed/20240105001500.export.CSV.zip.part", b"no archive")], "path string, content binary"
    )
    archives = materialize(
        packed.union(broken).withColumns(
            {"length": F.length("content").cast("long"), "modificationTime": F.lit("2024-02-01").cast("timestamp")}
        )
    )
    part = F.crc32(F.col("path").cast("binary")) % 3 == 0
    counts = []
    for offered in (archives.where(part), archives, archives):
        found = land_listed(
            offered.select("path", "length", "modificationTime"),
            lambda paths: archives.join(
                layers.spark.createDataFrame([(p,) for p in paths], "path string"), "path", "left_semi"
            ).select("path", "modificationTime", "length", "content"),
            path,
        )
        counts.append((found.known, found.landed + found.refused))
    assert counts[0][0] == 0 and counts[1][0] == counts[0][1], counts
    assert counts[2] == (sum(counts[1]), 0), counts
    return path


@query("land_ledger", f"SELECT {TYPED_SQL} FROM typed_events")
def _(layers):
    path = landed_in_turns(layers)
    return events.cast_events(lake.read_table(layers.spark, path, RAW_EVENTS))


@query(
    "ledger_entries",
    """SELECT day, count(*) AS landed, sum(n)::BIGINT AS lines FROM (
           SELECT CAST(CAST(DATEADDED AS DATE) AS VARCHAR) AS day, DATEADDED, count(*) AS n FROM typed_events
           WHERE DATEADDED IS NOT NULL GROUP BY ALL) GROUP BY day""",
)
def _(layers):
    entries = ledger(layers.spark, landed_in_turns(layers)).where(F.col("reason").isNull())
    day = F.to_date(F.substring("archive", 1, 8), "yyyyMMdd").cast("string").alias("day")
    return entries.groupBy(day).agg(F.count(F.lit(1)).alias("landed"), F.sum("lines").alias("lines"))


@query(
    "table_versions",
    f"""SELECT label, CAST(CAST(Datetime AS DATE) AS VARCHAR) AS day, count(*) AS n FROM (
            SELECT 'before' AS label, Datetime FROM silver_candles WHERE Datetime < TIMESTAMP '{DAY}'
            UNION ALL SELECT 'during', Datetime FROM silver_candles WHERE Datetime < TIMESTAMP '{DAY}'
            UNION ALL SELECT 'after', Datetime FROM silver_candles
            UNION ALL SELECT 'both', Datetime FROM silver_candles WHERE CAST(Datetime AS DATE) <> DATE '{DAY}')
        WHERE Datetime IS NOT NULL GROUP BY ALL""",
)
def _(layers):
    """Readers before, in the middle of and after a rebuild, and two writers of days at once."""
    spark, path = layers.spark, fresh_folder(layers.spark, "versions")
    rows = layers.candles.where(F.col("Datetime").isNotNull())
    lake.write_whole(rows.where(F.col("Datetime") < F.lit(DAY).cast("timestamp")), path, "Datetime")
    before = lake.read_table(spark, path, SILVER_CANDLES)
    staged = versions.stage(rows, path, "Datetime")
    during = lake.read_table(spark, path, SILVER_CANDLES)
    versions.publish(spark, path, staged, "whole")
    after = lake.read_table(spark, path, SILVER_CANDLES)
    # Two writers stage upon one version: the second one's change goes on top of the first's.
    last = rows.where(F.to_date("Datetime") == DAY)
    one = versions.stage(last, path, "Datetime")
    two = versions.stage(last.limit(0).unionByName(last), path, "Datetime")
    versions.publish(spark, path, one, "days")
    versions.publish(spark, path, two, "days")
    both = lake.read_table(spark, path, SILVER_CANDLES).where(F.to_date("Datetime") != DAY)
    tagged = {"before": before, "during": during, "after": after, "both": both}
    parts = [df.select(F.lit(k).alias("label"), "Datetime") for k, df in tagged.items()]
    whole = reduce(DataFrame.union, parts)
    return whole.groupBy("label", F.to_date("Datetime").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "day_scan",
    f"SELECT {CANDLE_SQL} FROM silver_candles WHERE CAST(Datetime AS DATE) = DATE '{DAY}'",
)
def _(layers):
    path = fresh_folder(layers.spark, "candles")
    lake.write_days(layers.candles, path, "Datetime")
    return lake.read_day(layers.spark, path, SILVER_CANDLES, DAY)


@query(
    "days_scan",
    f"""SELECT {CANDLE_SQL} FROM silver_candles
        WHERE CAST(Datetime AS DATE) IN (DATE '{DAY}', DATE '2024-01-10', DATE '1999-01-01')""",
)
def _(layers):
    path = fresh_folder(layers.spark, "candles")
    lake.write_days(layers.candles, path, "Datetime")
    return lake.read_days(layers.spark, path, SILVER_CANDLES, [DAY, "2024-01-10", "1999-01-01"])


@query("several_paths", f"SELECT {CANDLE_SQL} FROM silver_candles")
def _(layers):
    one, two = (fresh_folder(layers.spark, name) for name in ("one", "two"))
    early = F.to_date("Datetime") < DAY
    lake.write_days(layers.candles.where(early), one, "Datetime")
    lake.write_days(layers.candles.where(~early), two, "Datetime")
    return lake.read_folders(layers.spark, [one, two], SILVER_CANDLES)


# --- jobs -----------------------------------------------------------------------------


@query("silver_survives", f"SELECT {SILVER_SQL} FROM silver_events", digits=6)
def _(layers):
    """A rebuild from an empty folder leaves the table as it was."""
    spark, silver = layers.spark, fresh_folder(layers.spark, "silver")
    assert jobs.events_history(spark, land_events(layers), silver, RULES)
    assert not jobs.events_history(spark, empty_folder(layers), silver, RULES)
    return lake.read_table(spark, silver, SILVER_EVENTS)


@query("job_events_daily", f"SELECT {SILVER_SQL} FROM silver_events", digits=6)
def _(layers):
    """History up to the last two days, then those day by day, one of them twice."""
    spark, silver = layers.spark, fresh_folder(layers.spark, "silver")
    raw = land_events(layers)
    landed = spark.read.parquet(raw)
    last = [r[0] for r in landed.select(lake.DAY).distinct().orderBy(F.desc(lake.DAY)).limit(2).collect()]
    early = land_events(layers, landed.where(~F.col(lake.DAY).isin(*last)).drop(lake.DAY))
    jobs.events_history(spark, early, silver, RULES)
    for day in [*reversed(last), last[0]]:
        jobs.events_daily(spark, raw, silver, str(day), RULES)
        spark.catalog.refreshByPath(silver)
    return lake.read_table(spark, silver, SILVER_EVENTS)


@query("job_candles", f"SELECT {CANDLE_SQL} FROM silver_candles")
def _(layers):
    """The day of the check is landed later than all others."""
    spark, silver = layers.spark, fresh_folder(layers.spark, "silver")
    first, raw = (fresh_folder(spark, name) for name in ("first", "raw"))
    typed = layers.typed_candles
    lake.write_days(typed.where(F.to_date("Datetime") != DAY), first, "Datetime")
    lake.write_days(typed, raw, "Datetime")
    jobs.candles_history(spark, first, silver)
    jobs.candles_daily(spark, raw, silver, DAY)
    spark.catalog.refreshByPath(silver)
    return lake.read_table(spark, silver, SILVER_CANDLES)


@query("job_index", f"{GOLD_SQL} FROM gold", digits=6)
def _(layers):
    """The whole index, then one day of it computed alone and put in its place."""
    spark = layers.spark
    c, e, g = (fresh_folder(spark, name) for name in ("candles", "events", "gold"))
    lake.write_days(layers.candles, c, "Datetime")
    lake.write_days(layers.events, e, "DATEADDED")
    jobs.index_history(spark, c, e, g)
    jobs.index_daily(spark, c, e, g, DAY)
    spark.catalog.refreshByPath(g)
    return lake.read_table(spark, g, GOLD)


@query("index_from_slots", f"{GOLD_SQL} FROM gold", digits=6)
def _(layers):
    """Events come in three pieces; each index after them reads kept slots only."""
    spark = layers.spark
    c, e, g, k = (fresh_folder(spark, name) for name in ("candles", "events", "gold", "slots"))
    lake.write_days(layers.candles, c, "Datetime")
    everything = materialize(layers.events)
    piece = F.crc32(F.col("GlobalEventID").cast("string").cast("binary")) % 3
    lake.write_whole(everything.where(piece == 0), e, "DATEADDED")
    jobs.index_history(spark, c, e, g, slots=k)
    for number in (1, 2):
        lake.write_days(everything.where(piece == number), e, "DATEADDED", mode="append")
    jobs.index_daily(spark, c, e, g, DAY, slots=k)
    day = lake.read_day(spark, g, GOLD, DAY)
    jobs.index_history(spark, c, e, g, slots=k)
    rest = lake.read_table(spark, g, GOLD).where(F.to_date("Datetime") != DAY)
    return rest.unionByName(day)


@query(
    "hist_avg_one",
    """SELECT date_trunc('day', min(Datetime)) AS bucket,
              CAST((datediff('day', min(Datetime), max(Datetime)) + 1) * 86400 AS INTEGER) AS interval_seconds,
              round(avg(Volume), 6) AS Volume FROM candle_gold""",
    digits=6,
)
def _(layers):
    """The automatic interval with a limit of one bucket."""
    volumes = serving.one_per_candle(layers.stored_gold, ["Volume"])
    return serving.average_auto(volumes, ["Volume"], max_buckets=1)


@query("serve_job", "SELECT count(*) AS written, 'MissingTable' AS without_index FROM gold")
def _(layers):
    """Documents of a stored index; without one, or with an empty folder, an error and no documents."""
    spark, path, out = layers.spark, fresh_folder(layers.spark, "gold"), fresh_folder(layers.spark, "documents")
    lake.write_whole(layers.gold, path, "Datetime")
    account = jobs.serve(spark, path, out)
    errors = set()
    for missing in (fresh_folder(spark, "nowhere"), empty_folder(layers)):
        nothing = fresh_folder(spark, "documents")
        try:
            jobs.serve(spark, missing, nothing)
        except lake.MissingTable as error:
            errors.add(type(error).__name__)
        assert not lake.has_files(spark, nothing)
    written = spark.read.text(out)
    assert account.errors == 0 and account.success == written.count()
    return written.agg(F.count(F.lit(1)).alias("written"), F.lit(", ".join(errors)).alias("without_index"))
