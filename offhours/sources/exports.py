"""Landed event exports: the file catalogue, plain TSV, and zip archives."""

from __future__ import annotations

import zipfile
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offhours.functions.moments import compact_timestamp
from offhours.schemas import RAW_EVENT_COLUMNS, RAW_EVENTS
from offhours.sources.lake import MissingTable

# Cell texts that mean "missing" (the default set of pandas).
MISSING_TEXT = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

EXPORT_PATTERN = ".export.CSV.zip"

CHUNK_ROWS = 20_000

TSV = {"sep": "\t", "quote": '"', "escape": '"'}


def parse_catalogue(lines: DataFrame, column: str = "value") -> DataFrame:
    """``size hash url`` lines to columns, with the slot named in the URL."""
    parts = F.split(F.trim(column), " ")
    url = F.get(parts, F.lit(2))
    return lines.select(
        F.get(parts, F.lit(0)).alias("size"),
        F.get(parts, F.lit(1)).alias("hash"),
        url.alias("url"),
        compact_timestamp(F.regexp_extract(url, r"/(\d{14})\.", 1)).alias("slot"),
    )


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return parse_catalogue(spark.read.text(path))


def export_files(catalogue: DataFrame, since: str, sort: bool = True) -> DataFrame:
    """Event exports from ``since`` on, in time order."""
    exports = catalogue.where(
        F.col("url").rlike(EXPORT_PATTERN) & (F.col("slot") >= F.lit(since).cast("timestamp"))
    )
    return exports.orderBy("slot", "url") if sort else exports


def _known_text(rows: DataFrame) -> DataFrame:
    """The export's columns with texts that mean "missing" as null."""
    return rows.select(
        *[
            F.when(~F.col(c).isin(MISSING_TEXT), F.col(c)).alias(c) if c in RAW_EVENT_COLUMNS else F.col(c)
            for c in rows.columns
        ]
    )


def read_tsv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Headerless tab-separated exports as 61 text columns, missing text as null."""
    reader = spark.read.schema(RAW_EVENTS).option("header", False).options(**TSV)
    return _known_text(reader.csv(paths))


def unpack_archives(archives: DataFrame) -> DataFrame:
    """Rows of all members of zip archives given as ``(path, content)``.

    Spark has no zip reader, so a function unzips; it yields lines, which Spark
    parses as it does those of plain files. A task holds a batch of archives, as
    Spark hands them over (64 MB at most, or one that is larger), and
    ``CHUNK_ROWS`` lines of a member.
    """

    def lines_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive:
                    for member in archive.namelist():
                        with archive.open(member) as lines:
                            yield from chunks(path.as_py(), member, lines)

    def chunks(path: str, member: str, lines) -> Iterator[pa.RecordBatch]:
        while some := [line.rstrip(b"\r\n") for line in islice(lines, CHUNK_ROWS)]:
            text = [line.decode("utf-8", "replace") for line in some if line.strip()]
            n = len(text)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * n), pa.array([member] * n), pa.array(text)],
                    ["archive", "member", "line"],
                )

    lines = archives.select("path", "content").mapInArrow(
        lines_of, "archive string, member string, line string"
    )
    fields = ", ".join(f"`{c}` STRING" for c in RAW_EVENT_COLUMNS)
    row = F.from_csv("line", F.lit(fields), TSV).alias("row")
    return _known_text(lines.select("archive", "member", row).select("archive", "member", "row.*"))


def list_archives(spark: SparkSession, path: str, pattern: str = "*.zip") -> DataFrame:
    """``path``, ``modificationTime`` and ``length`` of every archive below ``path``, unopened."""
    return _binary_files(spark, path, pattern).select("path", "modificationTime", "length")


def open_archives(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The named archives with their content."""
    return spark.read.format("binaryFile").load(paths)


def _binary_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    try:
        return (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", True)
            .load(path)
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingTable(path) from error
        raise


def read_archives(spark: SparkSession, path: str, pattern: str = "*.zip") -> DataFrame:
    """Rows of every zip archive below ``path``; archives are spread over tasks."""
    return unpack_archives(_binary_files(spark, path, pattern))
