"""Clean events as they land, with Structured Streaming.

The daily job as a stream: every raw file that has not been seen is cleaned and
its new events are added to the clean table. Started with ``available_now`` it
takes in what has landed since the last run and stops, whichever days that is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from offhours.operators.merge import new_only
from offhours.plans.events import EVENT_KEY, EventRules, clean_events
from offhours.schemas import RAW_EVENTS, SILVER_EVENTS
from offhours.sources.lake import MissingTable, read_table, write_days


def add_events(silver: str, rules: EventRules = EventRules()):
    """A batch handler that adds the new events of a raw batch to the clean table.

    A batch that is repeated after a failure finds its events already there and
    adds none twice.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        clean = clean_events(batch, rules)
        try:
            existing = read_table(batch.sparkSession, silver, SILVER_EVENTS)
        except MissingTable:
            existing = None
        if existing is not None:
            clean = new_only(existing, clean, EVENT_KEY)
        write_days(clean, silver, "DATEADDED", mode="append")

    return handle


def clean_landed_events(
    spark: SparkSession,
    raw: str,
    silver: str,
    checkpoint: str,
    rules: EventRules = EventRules(),
    available_now: bool = True,
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Start the stream; state on which files were read is kept in ``checkpoint``."""
    files = (
        spark.readStream.schema(RAW_EVENTS)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(raw)
    )
    writer = files.writeStream.foreachBatch(add_events(silver, rules)).option(
        "checkpointLocation", checkpoint
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": "15 minutes"}
    return writer.trigger(**trigger).start()
