"""Landing: what a catalogue offers, what has landed, and what is missing.

The raw table has a folder per day and landing, so an archive lands without a look at any
other. Beside them lies a ledger: a row per archive and landing with its size, hash and
what became of it. Only archives that the ledger does not know, or knows otherwise, are
opened; broken ones are entered with the reason and hold nobody up. Only where an archive
comes again with other bytes is the folder that holds its former rows written anew.
"""

from __future__ import annotations

import hashlib
import logging
import uuid
import zipfile
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offhours.functions.moments import compact_timestamp
from offhours.operators.slots import slot_completeness
from offhours.schemas import RAW_EVENTS
from offhours.session import delete_folder, fresh_folder, materialize
from offhours.sources.exports import (
    export_files,
    list_archives,
    open_archives,
    read_catalogue,
    unpack_archives,
)
from offhours.sources.lake import DAY, MissingTable, has_files, write_days

log = logging.getLogger("offhours")

ARCHIVE = "archive"
RUN = "run"
# Hidden from readers of the raw table, as its name begins with an underscore.
LEDGER = "_ledger"
# An archive that inflates beyond this is refused.
MOST_INFLATED = 4 << 30

_FOUND = "archive string, bytes long, modified timestamp, hash string, members int, lines long, reason string"
_ENTRY = f"{_FOUND}, landed timestamp, run string"


@dataclass(frozen=True)
class Landing:
    """How many archives there were, were known already, landed, and were refused."""

    seen: int
    known: int
    landed: int
    refused: int


def file_name(path: str = "path"):
    return F.regexp_extract(path, r"([^/]+)$", 1)


def ledger(spark: SparkSession, raw_path: str) -> DataFrame:
    """The latest entry of every archive that was ever to land; ``reason`` is null where it did."""
    path = f"{raw_path.rstrip('/')}/{LEDGER}"
    try:
        entries = spark.read.schema(_ENTRY).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        entries = spark.createDataFrame([], _ENTRY)
    rest = [c for c in entries.columns if c not in (ARCHIVE, "landed", "run")]
    latest = F.max(F.struct("landed", "run", *rest)).alias("e")
    return entries.groupBy(ARCHIVE).agg(latest).select(ARCHIVE, "e.*")


def unknown_archives(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Listed files whose name, size and time of change the ledger does not hold."""
    files = listed.withColumn(ARCHIVE, file_name())
    held = known.select(
        F.col(ARCHIVE).alias("_name"), F.col("bytes").alias("_bytes"), F.col("modified").alias("_modified")
    )
    same = (
        (F.col(ARCHIVE) == F.col("_name"))
        & (F.col("length") == F.col("_bytes"))
        & (F.col("modificationTime") == F.col("_modified"))
    )
    return files.join(held, same, "left_anti")


def inspect_archives(files: DataFrame, most: int = MOST_INFLATED) -> DataFrame:
    """Hash, members and lines of each archive, or the ``reason`` for which it is refused.

    Members are read through once, as a stream, so that their checksums are tested; an
    archive is refused as soon as it inflates beyond ``most`` bytes.
    """

    def look(content) -> tuple[int, int, str | None]:
        members = lines = size = 0
        try:
            with zipfile.ZipFile(pa.BufferReader(content)) as archive:
                for member in archive.infolist():
                    members += 1
                    with archive.open(member) as stream:
                        for line in stream:
                            lines += bool(line.strip())
                            size += len(line)
                            if size > most:
                                return members, 0, f"inflates beyond {most} bytes"
        except (zipfile.BadZipFile, EOFError, OSError, NotImplementedError, RuntimeError, ValueError) as error:
            return members, 0, f"{type(error).__name__}: {error}"
        except Exception as error:  # zlib.error has no public base class of its own
            if type(error).__module__ != "zlib":
                raise
            return members, 0, f"zlib: {error}"
        return members, lines, None

    def run(it):
        for batch in it:
            out = []
            for row in range(batch.num_rows):
                content = batch.column(3)[row].as_buffer()
                members, lines, reason = look(content)
                out.append((hashlib.sha256(content).hexdigest(), members, lines, reason))
            digests, members, lines, reasons = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array(digests, pa.string()),
                    pa.array(members, pa.int32()),
                    pa.array(lines, pa.int64()),
                    pa.array(reasons, pa.string()),
                ],
                ["archive", "bytes", "modified", "hash", "members", "lines", "reason"],
            )

    columns = [file_name().alias(ARCHIVE), "length", "modificationTime", "content"]
    return files.select(*columns).mapInArrow(run, _FOUND)


def land_archives(
    spark: SparkSession, archives_path: str, raw_path: str, pattern: str = "*.export.CSV.zip"
) -> Landing | None:
    """Land what is new below a folder; None where there are no archives.

    Of files that the ledger knows by name, size and time of change nothing but the listing
    is read. Another time with the same bytes only renews the entry. Running it again, or
    after a crash, lands nothing twice: an archive's rows replace its former ones, and it is
    entered when they are written.
    """
    try:
        listed = list_archives(spark, archives_path, pattern)
    except MissingTable:
        return None
    return land_listed(listed, lambda paths: open_archives(spark, paths), raw_path)


def land_listed(
    listed: DataFrame, opened: Callable[[list[str]], DataFrame], raw_path: str
) -> Landing | None:
    """`land_archives` for any store: a listing, and what opens the archives at some paths."""
    spark = listed.sparkSession
    seen = listed.count()
    if not seen:
        return None
    known = ledger(spark, raw_path)
    todo = [r["path"] for r in unknown_archives(listed, known).select("path").collect()]
    if not todo:
        return Landing(seen, seen, 0, 0)
    found = materialize(inspect_archives(opened(todo)))
    changed = found.where(F.col("reason").isNull()).join(
        known.where(F.col("reason").isNull()).select(ARCHIVE, "hash"), [ARCHIVE, "hash"], "left_anti"
    )
    names = {r[ARCHIVE]: r["lines"] for r in changed.select(ARCHIVE, "lines").collect()}
    paths = [p for p in todo if p.rsplit("/", 1)[-1] in names]
    before = known.select(ARCHIVE).join(found.select(ARCHIVE), ARCHIVE, "left_semi")
    again = not before.isEmpty()
    run = _new_run()
    if paths:
        # Archives that the ledger has never seen have no rows that could be in the way.
        land_rows(unpack_archives(opened(paths)), raw_path, run, replace=again)
    empty = [name for name, lines in names.items() if not lines]
    if again and empty:
        _drop_former(spark, raw_path, spark.createDataFrame([(n,) for n in empty], "archive string"), None)
    entries = found.withColumns({"landed": F.current_timestamp(), RUN: F.lit(run)})
    entries.coalesce(1).write.mode("append").parquet(f"{raw_path.rstrip('/')}/{LEDGER}")
    refused = found.where(F.col("reason").isNotNull())
    for r in refused.orderBy(ARCHIVE).limit(5).collect():
        log.error("refused %s: %s", r[ARCHIVE], r["reason"])
    return Landing(seen, seen - len(todo), len(names), refused.count())


def _day_of(archive):
    """The day in an archive's name, as a partition value; null without one."""
    stamp = F.regexp_extract(archive, r"^(\d{14})\.", 1)
    return F.to_date(F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss")))


def _new_run() -> str:
    return f"r-{uuid.uuid4().hex}"


def land_rows(rows: DataFrame, raw_path: str, run: str | None = None, replace: bool = True) -> None:
    """Write the rows of unpacked archives into the raw table, in new folders of their days.

    Folders go by the day in the archive's name (archives without one share the null day)
    and the landing. An archive that lands again replaces its own rows; of the days at hand
    the names of archives are read for that, unless ``replace`` says that none is there yet.
    What lands at the same time goes to other folders. A crash leaves both the former and the
    new rows of an archive; the ledger does not know the new ones, so they land once more.
    """
    spark, run = rows.sparkSession, run or _new_run()
    columns = [c for c in rows.columns if c not in ("archive", "member")]
    named = rows.select(*columns, file_name("archive").alias(ARCHIVE))
    _write_run(named.withColumns({DAY: _day_of(F.col(ARCHIVE)), RUN: F.lit(run)}), raw_path, "append")
    if replace and has_files(spark, raw_path):
        # What was written is read, so that the archives are unpacked once.
        new = _landed_rows(spark, raw_path).where(F.col(RUN) == run)
        days = [r[0] for r in new.select(DAY).distinct().collect()]
        _drop_former(spark, raw_path, new.select(ARCHIVE).distinct(), days, run)
    spark.catalog.refreshByPath(raw_path)


def _landed_rows(spark: SparkSession, raw_path: str) -> DataFrame:
    """The raw table with the columns that its folders go by."""
    schema = T.StructType(
        [*RAW_EVENTS.fields, *(T.StructField(c, T.StringType()) for c in (ARCHIVE, RUN)), T.StructField(DAY, T.DateType())]
    )
    return spark.read.schema(schema).parquet(raw_path)


def _write_run(rows: DataFrame, raw_path: str, mode: str) -> None:
    (
        rows.hint("rebalance", F.col(DAY))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY, RUN)
        .parquet(raw_path)
    )


def _drop_former(
    spark: SparkSession, raw_path: str, archives: DataFrame, days: list | None, run: str = ""
) -> None:
    """Take the rows of archives out of all landings but one, in the given days (None: any).

    The days are literals, so other days are not listed as input. Only names are read to find
    the folders that hold such an archive; those that hold nothing else go, of the others the
    rest is written anew, all at once, and no other folder.
    """
    if not has_files(spark, raw_path):
        return
    raw = _landed_rows(spark, raw_path).where(F.col(RUN) != run)
    if days is not None:
        dated = [F.lit(d) for d in days if d is not None]
        raw = raw.where(F.col(DAY).isin(*dated) | (F.col(DAY).isNull() if None in days else F.lit(False)))
    gone = F.coalesce("_gone", F.lit(False))
    held = (
        raw.select(ARCHIVE, DAY, RUN)
        .distinct()
        .join(archives.select(ARCHIVE, F.lit(True).alias("_gone")), ARCHIVE, "left")
        .groupBy(DAY, RUN)
        .agg(F.bool_or(gone).alias("some"), F.bool_and(gone).alias("whole"))
    )
    folders = held.where("some").collect()
    torn = [(r[DAY], r[RUN]) for r in folders if not r["whole"]]
    if torn:
        names = spark.createDataFrame(torn, f"_day date, {RUN} string")
        inside = raw.where(F.col(RUN).isin(sorted({r for _, r in torn})))
        inside = inside.join(F.broadcast(names), [F.col(DAY).eqNullSafe(F.col("_day")), inside[RUN] == names[RUN]], "left_semi")
        path = fresh_folder(spark, "rest")
        inside.join(archives, ARCHIVE, "left_anti").write.parquet(path)
        _write_run(spark.read.schema(raw.schema).parquet(path), raw_path, "overwrite")
        delete_folder(spark, path)
    for day, of in [(r[DAY], r[RUN]) for r in folders if r["whole"]]:
        delete_folder(spark, f"{raw_path.rstrip('/')}/{DAY}={day or '__HIVE_DEFAULT_PARTITION__'}/{RUN}={of}")


def landed_slots(spark: SparkSession, raw_path: str) -> DataFrame:
    """``slot`` of every archive that has landed, by its name; no raw row is read."""
    landed = ledger(spark, raw_path).where(F.col("reason").isNull())
    return landed.select(compact_timestamp(F.regexp_extract(ARCHIVE, r"^(\d{14})\.", 1)).alias("slot")).where(
        F.col("slot").isNotNull()
    )


def landing_report(spark: SparkSession, raw_path: str, days: DataFrame) -> DataFrame:
    """Expected, present and missing quarter hours of the listed days, from the ledger."""
    return day_report(landed_slots(spark, raw_path), days, "slot")


def land_candles(candles: DataFrame, raw_path: str) -> None:
    """Write downloaded candles into the raw table, one folder per day."""
    write_days(candles.where(F.col("Datetime").isNotNull()), raw_path, "Datetime")


def expected_exports(spark: SparkSession, catalogue_path: str, since: str) -> DataFrame:
    return export_files(read_catalogue(spark, catalogue_path), since)


def day_report(landed: DataFrame, days: DataFrame, ts: str) -> DataFrame:
    """Expected, present and missing quarter-hour slots of the listed days."""
    return slot_completeness(landed, days, ts)
