"""Parquet tables of the lake: partitioned by day, replaced day by day.

Tables that were ever built whole have versions (`sources.versions`): they change in one
step, and readers keep the version they began with. Others are plain folders of days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offhours.sources import versions
from offhours.sources.versions import DAY, hadoop


class MissingTable(FileNotFoundError):
    """A table that must exist does not, or holds no files."""


class EmptyResult(ValueError):
    """A rebuild came out without a row; the table it was to replace stays."""


_hadoop = hadoop


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a data file, at any depth; stops at the first one."""
    fs, place = _hadoop(spark, path)
    if not fs.exists(place):
        return False
    files = fs.listFiles(place, True)
    while files.hasNext():
        relative = files.next().getPath().toString()[len(fs.makeQualified(place).toString()) :]
        if not any(part[:1] in ("_", ".") for part in relative.split("/") if part):
            return True
    return False


def _require_files(spark: SparkSession, paths: Sequence[str]) -> None:
    if not any(has_files(spark, p) for p in paths):
        raise MissingTable(", ".join(paths))


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def _partitioned(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, day_column: bool = False
) -> DataFrame:
    """A day-partitioned table with its declared schema (no footer is merged or sampled).

    A folder that does not exist or holds no files is missing; other errors rise
    as they are. A table with versions is read as of the latest one.
    """
    return _read(spark, path, schema, day_column)


def _read(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    day_column: bool,
    days: Sequence[str] | None = None,
) -> DataFrame:
    _recover(spark, path)
    version = versions.current(spark, path)
    if version:
        df = versions.read(spark, path, schema, version, days)
    else:
        _require_files(spark, [path])
        df = spark.read.schema(_partitioned(schema)).parquet(path)
    return df.select(*[f"`{c}`" for c in schema.names], *([DAY] if day_column else []))


def read_day(spark: SparkSession, path: str, schema: T.StructType, day: str) -> DataFrame | None:
    """One day's folder of a table, or None when nothing landed that day."""
    try:
        whole = _read(spark, path, schema, True, [day])
    except MissingTable:
        return None
    rows = whole.where(F.col(DAY) == F.lit(day).cast("date")).drop(DAY)
    return None if rows.isEmpty() else rows


def read_days(
    spark: SparkSession, path: str, schema: T.StructType, days: Sequence[str]
) -> DataFrame:
    """An explicit list of days; only their folders are read."""
    wanted = [F.lit(d).cast("date") for d in days]
    return _read(spark, path, schema, True, days).where(F.col(DAY).isin(*wanted)).drop(DAY)


def stored_days(spark: SparkSession, path: str) -> set[dt.date]:
    """The days that a table has folders for; no data file is opened."""
    version = versions.current(spark, path)
    found = version.days() if version else {
        n.removeprefix(f"{DAY}=") for n in versions.names(spark, path) if n.startswith(f"{DAY}=")
    }
    return {dt.date.fromisoformat(d) for d in found if d != versions.NO_DAY}


def read_folders(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """Every Parquet file below the given folders, however they are nested.

    Of tables with versions these are the files of the latest one.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    latest = [versions.current(spark, p) for p in paths]
    paths = [
        f for p, v in zip(paths, latest) for f in ([f"{p.rstrip('/')}/{d}" for d in v.folders] if v else [p])
    ]
    reader = spark.read.option("recursiveFileLookup", True).option("mergeSchema", False)
    reader = reader.schema(schema) if schema else reader
    _require_files(spark, paths)
    try:
        return reader.parquet(*paths)
    except AnalysisException as error:
        if _is_missing(error):
            raise MissingTable(", ".join(paths)) from error
        raise


def by_day(df: DataFrame, ts: str) -> DataFrame:
    """Add the partition column and bring each day's rows together.

    ``rebalance`` lets AQE split a day that holds much of the data over several
    tasks and join small days into one, so file sizes stay even. Rows without a
    timestamp go to the default partition.
    """
    return df.withColumn(DAY, F.to_date(ts)).hint("rebalance", F.col(DAY))


def write_days(df: DataFrame, path: str, ts: str, mode: str = "overwrite") -> None:
    """Write a table partitioned by the day of ``ts``, sorted by time inside its files.

    ``overwrite`` replaces only the days that ``df`` holds. Spark writes them
    aside and swaps them in when the job commits, so the table may also be an
    input of ``df``, and running the job again gives the same table. ``append``
    adds files. In a table with versions either gives a new version; a reader sees all
    of the change or nothing of it.
    """
    spark = df.sparkSession
    if versions.is_versioned(spark, path):
        staged = versions.stage(df, path, ts)
        if staged:
            versions.publish(spark, path, staged, "days" if mode == "overwrite" else "append")
            versions.vacuum(spark, path)
        return
    (
        by_day(df, ts)
        .sortWithinPartitions(DAY, ts)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )


def write_whole(df: DataFrame, path: str, ts: str) -> None:
    """Replace a whole table, which may itself be an input of ``df``.

    The new rows are written beside the old ones and become the table when their manifest is
    published: a job that fails, or that comes out without a row, leaves the old table as it
    was, and a reader gets the old table or the new one, never parts of both. The version
    before stays for those who still read it.
    """
    spark, target = df.sparkSession, path.rstrip("/")
    _recover(spark, target)
    staged = versions.stage(df, target, ts)
    if not staged:
        raise EmptyResult(target)
    versions.publish(spark, target, staged, "whole")
    versions.vacuum(spark, target)


def _recover(spark: SparkSession, target: str) -> None:
    """Put back a table that was set aside by the renaming swap of earlier releases.

    No writer moves folders any more, so nothing is under way when a table is found aside.
    """
    target = target.rstrip("/")
    fs, live = hadoop(spark, target)
    _, old = hadoop(spark, f"{target}__old")
    if not fs.exists(live) and fs.exists(old):
        fs.rename(old, live)
