"""Small helpers of the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offhours.session import RUNTIME_SETTINGS, delete_folder, fresh_folder

_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
# ASCII white space, as the contracts write it: [\x20\x09-\x0D].
WORD = rb"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set(_BATCH, RUNTIME_SETTINGS[_BATCH])  # also in sessions that others have made
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case.

    ``bytes.split`` and ``bytes.lower`` know ASCII only, so they are exactly
    the contracts' classes, whatever else the text holds.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


# Has Spark delete a query's shuffle files when the query has run.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here.

    The columns keep their names; executors can be lost at any later time
    without this work being done again. Shuffle files of the write go at once: nothing
    reads them again, and over many steps they would fill the disks.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table of `stored`, once all that reads it has been stored in turn."""
    delete_folder(table.sparkSession, table.stored_at)


def spare(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` bears it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, whatever characters that holds."""
    return df["`" + name.replace("`", "``") + "`"]


# Text that a function gets at once, if a row has not more by itself.
BATCH_BYTES = 2 << 20


def batches(
    fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], size: int = BATCH_BYTES, rows: int = 2000
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function on batches as ``mapInArrow`` wants it.

    Spark's batches hold many MB of text; ``fn`` gets some ``size`` bytes of it at a
    time, at most ``rows`` rows and at least one, which bounds the memory of what it
    derives from them.
    """
    owner = fn.__module__

    def run(it):
        begin(owner)
        for batch in it:
            for start, stop in cuts(batch, size, rows):
                out = fn(batch.slice(start, stop - start))
                if out is not None and out.num_rows:
                    yield out
        give_back()

    return run


_KEPT: dict[str, Callable[[], None]] = {}


def keeps(module: str, clear: Callable[[], None]) -> None:
    """Say that tasks of a module leave something to those after them, and how to let it go."""
    _KEPT[module] = clear


def begin(module: str) -> None:
    """Let go what tasks of other modules have left in this worker, as it is kept for all stages."""
    for name, clear in _KEPT.items():
        if name != module:
            clear()


def give_back() -> None:
    """Give memory that a task has freed back to the system: workers are kept for other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # a C library without it
        pass


def cuts(batch: pa.RecordBatch, size: int, rows: int) -> Iterator[tuple[int, int]]:
    """First and one behind the last row of each piece of a batch."""
    weights = np.zeros(batch.num_rows, np.int64)
    for values in batch.columns:
        if pa.types.is_string(values.type) or pa.types.is_binary(values.type):
            weights += pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        elif pa.types.is_list(values.type):
            weights += 8 * pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
    total = np.concatenate([[0], np.cumsum(weights)])
    at = 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(total, total[at] + size, side="right")) - 1
        stop = min(max(stop, at + 1), at + rows, batch.num_rows)
        yield at, stop
        at = stop


# -- sieves: bounded bitmaps of keys -----------------------------------------------------

SIEVE_BITS = 22


def sieve(keys: DataFrame, key: str, bits: int = SIEVE_BITS) -> DataFrame:
    """A bitmap over the hashed values of ``key``: at most ``2**(bits - 6)`` rows.

    Its size depends on ``bits`` only, so it may be broadcast whatever the size
    of the data. A value that is in ``keys`` always passes; another one may pass
    by chance, so an exact join follows wherever a sieve is used. On more data
    more rows pass by chance, which costs time and changes no result.
    """
    place = F.col(key).bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.expr(f"shiftleft(1L, cast(`{key}` & 63 as int))")
    return (
        keys.where(F.col(key).isNotNull())
        .groupBy(F.shiftright(place, 6).alias("_word"))
        .agg(F.bit_or(bit).alias("_bits"))
    )


def sifted(df: DataFrame, key: str, through: DataFrame, out: str, bits: int = SIEVE_BITS) -> DataFrame:
    """Add ``out``: whether the value of ``key`` passes the sieve (null keys do not)."""
    word = F.shiftright(F.col(key).bitwiseAND(F.lit((1 << bits) - 1)), 6)
    kept = df.columns
    joined = df.withColumn("_word", word).join(F.broadcast(through), "_word", "left")
    hit = F.expr(f"shiftright(_bits, cast(`{key}` & 63 as int)) & 1L") == 1
    return joined.select(*[column(joined, c) for c in kept], F.coalesce(hit, F.lit(False)).alias(out))


# -- connected components ----------------------------------------------------------------


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """Smallest reachable node of every node of an undirected graph.

    ``edges`` has columns ``a`` and ``b``; the result ``node`` and ``component``.
    Large-star and small-star steps in turn (Kiveris et al., 2014): each is a
    ``groupBy(...).min`` that combines map-side and a join, so a node with very
    many links never has to fit into one task. Each step is written to the
    shared folder.
    """
    links = stored(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = _digest(links)
    for _ in range(limit):
        large = _star(links.union(links.select("b", "a")), larger=True)
        links = stored(_star(large, larger=False), "links")
        after = _digest(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()


def _digest(links: DataFrame):
    """Number of links and two checksums of the set of them."""
    return tuple(
        links.agg(
            F.count(F.lit(1)),
            F.bit_xor(F.xxhash64("a", "b")),
            F.bit_xor(F.xxhash64("b", "a")),
        ).first()
    )


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest of them and of itself.

    ``larger``: only neighbours above the node; else those below it (then the
    links come as a > b).
    """
    least = links.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m")
    )
    near = links.join(least, "a")
    if larger:
        moved = near.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = near.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.where(F.col("a") != F.col("b")).distinct()


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
