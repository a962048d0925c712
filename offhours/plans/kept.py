"""Slot scores kept beside the events: an index reads slots, not events.

Every data folder of the event table has its own partial scores per slot. Both never change
once written, so bringing the kept slots up to date means working out the folders that are
new; running it again, or after a crash, adds nothing twice, and a rebuild of the events
leaves nothing behind. Which partials make up the table is what the events' manifest says.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offhours.operators.slots import merged_slots, slot_states
from offhours.schemas import SCORE_COLUMNS, SILVER_EVENTS
from offhours.sources import versions
from offhours.sources.lake import MissingTable
from offhours.sources.versions import BATCH, DAY, NO_DAY, Version

OF = "of"
STATE = T.StructType(
    [T.StructField("DATEADDED", T.TimestampType())]
    + [T.StructField(c, T.DoubleType()) for c in SCORE_COLUMNS]
    + [
        T.StructField("event_count", T.LongType()),
        T.StructField(
            "worst",
            T.StructType(
                [
                    T.StructField("geo_score_raw", T.DoubleType()),
                    T.StructField("actor_countries", T.ArrayType(T.StringType())),
                ]
            ),
        ),
    ]
)


def _partial(folder: str) -> str:
    """Folder of the kept slots that belongs to a folder of events."""
    batch, day = folder.split("/")
    return f"{OF}={batch.removeprefix(BATCH + '=')}/{day}"


def _present(spark: SparkSession, slots_path: str) -> set[str]:
    root = slots_path.rstrip("/")
    groups = [g for g in versions.names(spark, root) if g.startswith(f"{OF}=")]
    return {f"{g}/{d}" for g in groups for d in versions.names(spark, f"{root}/{g}") if d.startswith(f"{DAY}=")}


def _version(spark: SparkSession, events_path: str) -> Version:
    found = versions.current(spark, events_path)
    if found is None:
        raise MissingTable(f"{events_path} has no version")
    # Events without a timestamp are in no slot.
    return Version(found.number, tuple(f for f in found.folders if not f.endswith(NO_DAY)))


def update_slots(spark: SparkSession, events_path: str, slots_path: str, floor: bool = False) -> int:
    """Work out the slots of event folders that have none yet; the number of such folders.

    One job over the new folders alone: a folder's events stay together by its name.
    """
    version = _version(spark, events_path)
    present = _present(spark, slots_path)
    new = [f for f in version.folders if _partial(f) not in present]
    if new:
        events = versions.read(spark, events_path, SILVER_EVENTS, Version(version.number, tuple(new)), batch=True)
        states = slot_states(events, floor, [BATCH, DAY]).withColumnRenamed(BATCH, OF)
        (
            states.hint("rebalance", OF, DAY)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(OF, DAY)
            .parquet(slots_path)
        )
    return len(new)


def kept_slots(
    spark: SparkSession, events_path: str, slots_path: str, days: Sequence[str] | None = None
) -> DataFrame:
    """Scores per slot of the events' latest version, from kept partials (of ``days`` if given).

    The same as `slot_scores` over the events, but for the order in which doubles are added.
    Folders that `update_slots` has not seen yet are an error.
    """
    version = _version(spark, events_path)
    wanted = [f for f in version.folders if days is None or f.rsplit("=", 1)[1] in set(days)]
    present = _present(spark, slots_path)
    lacking = [f for f in wanted if _partial(f) not in present]
    if lacking:
        raise MissingTable(f"{slots_path} lacks {len(lacking)} folders of {events_path}, such as {lacking[0]}")
    if not wanted:
        states = spark.createDataFrame([], STATE)
    else:
        root = slots_path.rstrip("/")
        full = T.StructType([*STATE.fields, T.StructField(OF, T.StringType()), T.StructField(DAY, T.DateType())])
        paths = [f"{root}/{_partial(f)}" for f in wanted]
        states = spark.read.schema(full).option("basePath", root).parquet(*paths).drop(OF, DAY)
    return merged_slots(states)


def forget_slots(spark: SparkSession, events_path: str, slots_path: str) -> int:
    """Delete the partials of folders that no version of the events lists any more."""
    listed = {_partial(f) for v in versions.all_versions(spark, events_path) for f in v.folders}
    gone = _present(spark, slots_path) - listed
    for folder in gone:
        fs, place = versions.hadoop(spark, f"{slots_path.rstrip('/')}/{folder}")
        fs.delete(place, True)
    return len(gone)
