"""Jobs over stored tables: build everything, or bring one day up to date.

    python -m offhours.jobs land    --archives A --raw R [--date 2026-02-27]
    python -m offhours.jobs events  --mode history --raw R --silver S
    python -m offhours.jobs events  --mode daily --date 2026-02-27 --raw R --silver S
    python -m offhours.jobs candles --mode daily --date 2026-02-27 --raw R --silver S
    python -m offhours.jobs index   --mode daily --date 2026-02-27 --candles C --events E --gold G
    python -m offhours.jobs serve   --gold G --documents D

Tables are Parquet, partitioned by day. A daily run touches only the days it
changes, and running it again changes nothing; where the clean table does not
exist yet, it is built whole. A rebuild without input or without a row leaves
the table as it was.
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
from bisect import bisect_left
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from offhours import schemas
from offhours.operators.merge import new_only
from offhours.plans.candles import clean_candles, merge_candles
from offhours.plans.events import EVENT_KEY, EventRules, clean_events
from offhours.plans.gold import GoldRules, context_start, day_index, stress_index
from offhours.plans.kept import kept_slots, update_slots
from offhours.plans.landing import land_archives, landing_report
from offhours.plans.serving import absent_columns
from offhours.session import build_session, observed
from offhours.sources import versions
from offhours.sources.documents import WriteAccount, write_documents
from offhours.sources.lake import (
    DAY,
    EmptyResult,
    MissingTable,
    read_day,
    read_table,
    stored_days,
    write_days,
    write_whole,
)

log = logging.getLogger("offhours")


def _logged(df: DataFrame, ts: str, write: Callable[[DataFrame], None], label: str) -> int:
    """Write, and log how many rows of what time range; counted along with the write."""
    seen = Observation(label)
    write(
        df.observe(
            seen, F.count(F.lit(1)).alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last")
        )
    )
    found = observed(seen)
    rows = found.get("n", 0)
    log.info("%s: %d rows from %s to %s", label, rows, found.get("first"), found.get("last"))
    return rows


def _rebuilt(df: DataFrame, path: str, ts: str, label: str) -> bool:
    """Replace a whole table; without a row the old one stays."""
    try:
        _logged(df, ts, lambda rows: write_whole(rows, path, ts), label)
    except EmptyResult:
        log.error("no %s came out; %s stays as it is", label, path)
        return False
    return True


def land(spark: SparkSession, archives: str, raw: str, day: str | None = None) -> bool:
    """Unpack what is new among landed archives, of one day or all.

    Logs what came, and for a single day how many of its quarter hours are missing.
    """
    stamp = day.replace("-", "") if day else ""
    found = land_archives(spark, archives, raw, f"{stamp}*.export.CSV.zip")
    if found is None:
        log.info("no archives in %s", archives)
        return False
    log.info(
        "%d archives: %d known, %d landed, %d refused", found.seen, found.known, found.landed, found.refused
    )
    if day:
        days = spark.range(1).select(F.lit(day).cast("date").alias("day"))
        report = landing_report(spark, raw, days).first()
        log.info("%s: %d of %d slots, %d missing", day, report["present"], report["expected"], report["missing"])
    return True


def events_history(
    spark: SparkSession, raw: str, silver: str, rules: EventRules = EventRules()
) -> bool:
    """Build the clean event table from everything that landed.

    One job: the scan is split by Spark, so no batching by days and no second
    de-duplication pass is needed.
    """
    try:
        landed = read_table(spark, raw, schemas.RAW_EVENTS)
    except MissingTable:
        log.error("nothing landed in %s", raw)
        return False
    return _rebuilt(clean_events(landed, rules), silver, "DATEADDED", "events")


def events_daily(
    spark: SparkSession, raw: str, silver: str, day: str, rules: EventRules = EventRules()
) -> bool:
    """Add one landed day to the clean event table; events already there stay.

    Only new events are written, as additional files of their days. Without a
    clean table yet, all that landed is cleaned.
    """
    try:
        existing = read_table(spark, silver, schemas.SILVER_EVENTS)
    except MissingTable:
        return events_history(spark, raw, silver, rules)
    landed = read_day(spark, raw, schemas.RAW_EVENTS, day)
    if landed is None:
        log.info("no events landed on %s", day)
        return False
    added = new_only(existing, clean_events(landed, rules), EVENT_KEY)
    _logged(
        added,
        "DATEADDED",
        lambda df: write_days(df, silver, "DATEADDED", mode="append"),
        "events added",
    )
    return True


def candles_history(spark: SparkSession, raw: str, silver: str) -> bool:
    """Build the clean candle table from everything that landed."""
    try:
        landed = read_table(spark, raw, schemas.TYPED_CANDLES)
    except MissingTable:
        log.error("no candles landed in %s", raw)
        return False
    return _rebuilt(clean_candles(landed), silver, "Datetime", "candles")


def candles_daily(spark: SparkSession, raw: str, silver: str, day: str) -> bool:
    """Merge one landed day into the clean candle table.

    The change in percent links a day to the last close before it, so of each day that the
    landed candles belong to the day before is read along, and the day after is rewritten
    with it; days in between, if they are far apart, are left alone.
    """
    try:
        existing = read_table(spark, silver, schemas.SILVER_CANDLES, day_column=True)
    except MissingTable:
        return candles_history(spark, raw, silver)
    landed = read_day(spark, raw, schemas.TYPED_CANDLES, day)
    if landed is None:
        log.info("no candles landed on %s", day)
        return False
    # Days of the landed candles themselves: a feed day may hold late ones.
    own = landed.select(F.to_date("Datetime").alias("day")).where(F.col("day").isNotNull()).distinct()
    touched = {r["day"] for r in own.collect()} or {dt.date.fromisoformat(day)}
    days = sorted(stored_days(spark, silver) | touched)

    def beside(some: set[dt.date], step: int) -> set[dt.date]:
        places = [bisect_left(days, d) + step for d in some]
        return {days[i] for i in places if 0 <= i < len(days)}

    affected = touched | beside(touched, 1)
    context = affected | beside(affected, -1)
    near = existing.where(F.col(DAY).isin(*[F.lit(d) for d in context])).drop(DAY)
    merged = merge_candles(near, landed)
    changed = merged.where(F.to_date("Datetime").isin(*[F.lit(d) for d in affected]))
    _logged(changed, "Datetime", lambda df: write_days(df, silver, "Datetime"), "candles replaced")
    return True


def index_history(
    spark: SparkSession,
    candles: str,
    events: str,
    gold: str,
    rules: GoldRules = GoldRules(),
    slots: str | None = None,
) -> bool:
    """Build the whole index table; with ``slots``, a folder of kept slot scores, from these."""
    c = read_table(spark, candles, schemas.SILVER_CANDLES)
    if slots:
        update_slots(spark, events, slots, rules.floor_slots)
        e = kept_slots(spark, events, slots)
    else:
        e = read_table(spark, events, schemas.SILVER_EVENTS)
    return _rebuilt(stress_index(c, e, rules, slots=bool(slots)), gold, "Datetime", "index")


def index_daily(
    spark: SparkSession,
    candles: str,
    events: str,
    gold: str,
    day: str,
    rules: GoldRules = GoldRules(),
    slots: str | None = None,
) -> bool:
    """Recompute one day of the index and replace it.

    Where the context starts is found first (one value), so that only the
    folders from there on are read. With ``slots`` no events are read but those that
    have come since the kept slot scores were last brought up to date.
    """
    c = read_table(spark, candles, schemas.SILVER_CANDLES, day_column=True)
    start = context_start(c, day, rules).first()["start"]
    upto = F.col(DAY) <= F.lit(day).cast("date")
    since = F.col(DAY) >= F.lit(start.date()) if start else F.lit(True)

    def context(df: DataFrame) -> DataFrame:
        return df.where(upto & since).drop(DAY)

    if slots:
        update_slots(spark, events, slots, rules.floor_slots)
        first = str(start.date()) if start else ""
        days = [d for d in versions.current(spark, events).days() if first <= d <= day]
        e = kept_slots(spark, events, slots, days)
    else:
        e = context(read_table(spark, events, schemas.SILVER_EVENTS, day_column=True))
    fresh = day_index(context(c), e, day, rules, start=start, slots=bool(slots))
    # A day without an open candle gives no rows, which replace nothing: rows that an
    # earlier run wrote for it stay until the next rebuild.
    return _logged(fresh, "Datetime", lambda df: write_days(df, gold, "Datetime"), "index day") > 0


def serve(spark: SparkSession, gold: str, documents: str) -> WriteAccount:
    """Write the index as documents; a missing or empty index is an error."""
    rows = read_table(spark, gold, schemas.GOLD)
    for name in absent_columns(rows):
        log.warning("the index has no column %s", name)
    account = write_documents(rows, documents)
    log.info("%d documents written, %d refused", account.success, account.errors)
    for example in account.examples:
        log.error("refused: %s", example)
    return account


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="offhours.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    folders = {
        "events": ["raw", "silver"],
        "candles": ["raw", "silver"],
        "index": ["candles", "events", "gold"],
    }
    for name, options in folders.items():
        job = jobs.add_parser(name)
        job.add_argument("--mode", required=True, choices=["history", "daily"])
        job.add_argument("--date", help="the day to bring up to date (YYYY-MM-DD)")
        for option in options:
            job.add_argument(f"--{option}", required=True)
        if name == "index":
            job.add_argument("--slots", help="folder of kept slot scores")
    job = jobs.add_parser("land")
    job.add_argument("--archives", required=True)
    job.add_argument("--raw", required=True)
    job.add_argument("--date", help="only archives of this day (YYYY-MM-DD)")
    job = jobs.add_parser("serve")
    job.add_argument("--gold", required=True)
    job.add_argument("--documents", required=True)
    args = parser.parse_args(argv)
    if getattr(args, "mode", None) == "daily" and not args.date:
        parser.error("--date is required with --mode daily")
    return args


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    logging.basicConfig(level=logging.INFO)
    spark = build_session(f"offhours-{args.job}")
    daily = getattr(args, "mode", None) == "daily"
    if args.job == "events":
        run = events_daily if daily else events_history
        run(spark, args.raw, args.silver, *([args.date] if daily else []))
    elif args.job == "candles":
        run = candles_daily if daily else candles_history
        run(spark, args.raw, args.silver, *([args.date] if daily else []))
    elif args.job == "index":
        run = index_daily if daily else index_history
        day = [args.date] if daily else []
        kept = {"slots": args.slots} if args.slots else {}
        run(spark, args.candles, args.events, args.gold, *day, **kept)
    elif args.job == "land":
        land(spark, args.archives, args.raw, args.date)
    else:
        serve(spark, args.gold, args.documents)


if __name__ == "__main__":
    main()
