"""Mixing sources to target weights by Pfair scheduling.

The documents of each source, in a seeded order, are cut into blocks of equal
bytes. Block k of a source with weight w is released at floor((k - 1) / w) and
due at ceil(k / w); one block is served per slot, the released one with the
earliest deadline first. As the weights add up to 1, every deadline is met
(Baruah et al., 1996), and at any time each source has got its share of the
slots to within less than one block.

Windows follow from the exact weights, as fractions, so the bound holds over a
schedule of any length. There is a row per block, some thousands of times fewer
than bytes; each range of documents takes those that it covers. Slots of a source
that has run out may stay empty; the others go on in their weights. Every document
is placed exactly once. With a ``period``, weights are rounded to whole shares of
it instead, and one period's schedule repeats.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Mapping
from fractions import Fraction

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offhours.llm.shared import column, stored, table

BLOCK_BYTES = 1 << 18
# Weights below 1 in this many count as that, so that places fit into 64 bits.
LEAST_SHARE = 1 << 40
# Of 1 what sources without a weight get together, where named ones leave nothing.
LEFT = 1 / 1000
POWER = 0.5
SEED = 1
_BUCKET_BITS = 12
# Rows of a file that are numbered together.
_RUN_ROWS = 4096


def shares(weights: Mapping[str, float], period: int) -> dict[str, int]:
    """Whole shares of about ``period`` in all, in the proportion of the weights, 1 at least."""
    total = sum(weights.values())
    return {name: max(1, round(period * w / total)) for name, w in weights.items()}


def schedule(units: Mapping[str, int]) -> list[tuple[str, int, int, int, int]]:
    """One period: (source, block from 0, release, deadline, slot) of every block."""
    period = sum(units.values())
    due = []
    for name in sorted(units):
        q = units[name]
        # Window of block k: floor(k / w) to ceil((k + 1) / w), with w = q / period.
        due += [(k * period // q, -(-(k + 1) * period // q), name, k) for k in range(q)]
    due.sort()
    out, ready, at = [], [], 0
    for slot in range(period):
        while at < len(due) and due[at][0] <= slot:
            release, deadline, name, k = due[at]
            heapq.heappush(ready, (deadline, name, k, release))
            at += 1
        deadline, name, k, release = heapq.heappop(ready)
        assert slot < deadline, "an earliest-deadline-first schedule meets all deadlines"
        out.append((name, k, release, deadline, slot))
    return out


def whole_shares(weights: Mapping[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the proportion of the weights, but for those below 1 in LEAST_SHARE."""
    exact = {name: Fraction(w) for name, w in weights.items()}
    least = sum(exact.values()) / LEAST_SHARE
    exact = {name: max(w, least) for name, w in exact.items()}
    scale = math.lcm(*[w.denominator for w in exact.values()])
    return {name: int(w * scale) for name, w in exact.items()}


def whole_schedule(weights: Mapping[str, float], blocks: Mapping[str, int]) -> tuple[list[str], list[array]]:
    """Names of the sources, and of every block: source, number, release, deadline, slot.

    Block k of a source with weight w has the window floor(k / w) to ceil((k + 1) / w),
    ``blocks`` says how many each source has. Only its next block waits, as it is due
    before those behind it.
    """
    units = whole_shares(weights)
    total, names = sum(units.values()), sorted(units)
    q = [units[n] for n in names]
    out = [array("q") for _ in range(5)]
    coming = [(0, i, 0) for i, n in enumerate(names) if blocks[n]]
    ready, slot = [], 0
    while coming or ready:
        if not ready:
            slot = max(slot, coming[0][0])
        while coming and coming[0][0] <= slot:
            release, i, k = heapq.heappop(coming)
            heapq.heappush(ready, (-(-(k + 1) * total // q[i]), i, k, release))
        deadline, i, k, release = heapq.heappop(ready)
        assert slot < deadline, "an earliest-deadline-first schedule meets all deadlines"
        for column_, value in zip(out, (i, k, release, deadline, slot)):
            column_.append(value)
        if k + 1 < blocks[names[i]]:
            heapq.heappush(coming, ((k + 1) * total // q[i], i, k + 1))
        slot += 1
    return names, out


def _source(docs: DataFrame) -> Column:
    """Name of the source as text, so that a null source is one of its own."""
    return F.concat(F.lit("="), column(docs, "source").cast("string"))


def _size(docs: DataFrame) -> Column:
    """Bytes of the text, 1 at least."""
    return F.greatest(F.octet_length(F.coalesce(column(docs, "text"), F.lit(""))), F.lit(1)).cast("long")


def _targets(frame: pa.Table, weights: Mapping[str, float] | None, power: float, least: float) -> dict[str, float]:
    """The weight of each source of ``frame`` (``source``, ``bytes``), not yet in proportion to all."""
    natural = {
        name: float(size or 1) ** power
        for name, size in zip(frame["source"].to_pylist(), frame["bytes"].to_pylist())
    }
    if weights is not None:
        named = {n: weights[n[1:]] for n in natural if n[:1] == "=" and n[1:] in weights}
        named = {n: w for n, w in named.items() if w > 0}
        rest = {n: natural[n] for n in natural if n not in named}
        # The unnamed share what the named leave; nobody's documents are dropped.
        left = max(1.0 - sum(named.values()), least) if rest else 0.0
        total = sum(rest.values())
        natural = named | {n: left * w / total for n, w in rest.items()}
    return natural


def block_table(sizes: DataFrame, weights: Mapping[str, float] | None, block_bytes: int, power: float) -> DataFrame:
    """The schedule of all blocks of the sources of ``sizes`` (``source``, ``bytes``), a row each.

    Sources that ``weights`` does not name, or all when it is None, take the weight
    bytes ** power; named ones are put in proportion to all of these.
    """

    def plan(frame: pa.Table) -> pa.Table:
        blocks = {n: -(-b // block_bytes) for n, b in zip(frame["source"].to_pylist(), frame["bytes"].to_pylist())}
        names, (of, *places) = whole_schedule(_targets(frame, weights, power, LEFT), blocks)
        source = pa.array(names, pa.string()).take(pa.array(of, pa.int64()))
        return pa.table([source, *[pa.array(p, pa.int64()) for p in places]], ["source", "number", "release", "deadline", "slot"])

    schema = "source string, number long, release long, deadline long, slot long"
    return sizes.groupBy(F.lit(0).alias("one")).applyInArrow(plan, schema)


def period_table(sizes: DataFrame, weights: Mapping[str, float] | None, period: int, power: float) -> DataFrame:
    """The schedule of one period, with rounded weights, for the sources of ``sizes`` (``source``, ``bytes``).

    It has about ``period`` rows, or one per source if that is more. Weights are
    those of ``block_table``.
    """
    schema = (
        "source string, units long, period long, block long, release long, deadline long, period_slot long"
    )

    def plan(frame: pa.Table) -> pa.Table:
        units = shares(_targets(frame, weights, power, 1.0 / period), period)
        rows = schedule(units)
        names, blocks, release, deadline, slots = zip(*rows)
        return pa.table(
            {
                "source": names,
                "units": [units[n] for n in names],
                "period": [len(rows)] * len(rows),
                "block": blocks,
                "release": release,
                "deadline": deadline,
                "period_slot": slots,
            }
        )

    return sizes.groupBy(F.lit(0).alias("one")).applyInArrow(plan, schema)


def mixed(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    block_bytes: int = BLOCK_BYTES,
    period: int | None = None,
    power: float = POWER,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with where each document stands in the mixture, in the struct ``mix``.

    ``mix`` has ``slot`` (of the document's block), ``start`` (its first byte in its
    source's order), ``block``, ``release`` and ``deadline``. Sorting by slot and
    start gives the mixture. ``mix`` replaces a column of that name.

    Null sources are one source; null and empty texts count as one byte, so they
    have a place too. A document belongs to the block in which it starts. With no
    ``period`` each source is less than a block off its given weight, until it runs
    out; with one, off its rounded share of that.
    Repeated rows are all placed, next to one another. An empty table gives an
    empty result.

    Numbering a source, also one with most of the rows, takes no task that holds
    it whole: rows are ordered inside ``2 ** 12`` ranges of their hash, and ranges
    are offset by the sizes of those before.
    """
    key = F.xxhash64(column(docs, "doc_id").cast("string"), F.lit(seed))
    kept = [column(docs, c) for c in docs.columns if c.lower() != "mix"]
    rows = docs.select(
        F.struct(*kept).alias("doc"),
        F.coalesce(_source(docs), F.lit("-")).alias("source"),
        _size(docs).alias("size"),
        key.alias("key"),
        F.shiftright(key, 64 - _BUCKET_BITS).cast("int").alias("bucket"),
        F.xxhash64(column(docs, "text")).alias("tie"),
    )
    ranges = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bytes"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        "source", "bucket", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("offset")
    )
    sizes = ranges.groupBy("source").agg(F.sum("bytes").alias("bytes"))
    inside = (
        Window.partitionBy("source", "bucket")
        .orderBy("key", F.col("doc.doc_id"), "tie")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # The rows lie by range already, so only the small side moves.
    if period is None:
        covered = ranges.join(offsets, ["source", "bucket"]).select(
            "source", "bucket", "offset",
            F.explode(F.expr(f"sequence(offset div {int(block_bytes)}, (offset + bytes - 1) div {int(block_bytes)})")).alias("number"),
        )
        places = F.struct("number", "slot", "release", "deadline")
        windows = (
            covered.join(block_table(sizes, weights, int(block_bytes), power), ["source", "number"])
            .groupBy("source", "bucket", "offset")
            .agg(F.array_sort(F.collect_list(places)).alias("places"))
        )
        start = F.col("offset") + F.col("inside")
        # A range's blocks follow one another, so a number is also a place among them.
        mine = F.expr(f"places[cast((offset + inside) div {int(block_bytes)} - places[0].number as int)]")
        return placed.join(windows, ["source", "bucket"]).select("doc", start.alias("start"), mine.alias("at")).select(
            "doc.*",
            F.struct("at.slot", "start", F.col("at.number").alias("block"), "at.release", "at.deadline").alias("mix"),
        )
    periods = period_table(sizes, weights, period, power)
    numbered = placed.join(offsets, ["source", "bucket"]).select(
        "doc", "source", (F.col("offset") + F.col("inside")).alias("start")
    )
    blocks = numbered.withColumn("number", F.expr(f"start div {int(block_bytes)}"))
    # Broadcast tables have the rows of a period, whatever the data.
    units = periods.select("source", "units").distinct()
    in_period = blocks.join(F.broadcast(units), "source").withColumn("block", F.expr("number % units"))
    turn = F.expr("number div units") * F.col("period")
    return in_period.join(F.broadcast(periods.drop("units")), ["source", "block"]).select(
        "doc.*",
        F.struct(
            (turn + F.col("period_slot")).alias("slot"),
            "start",
            F.col("number").alias("block"),
            (turn + F.col("release")).alias("release"),
            (turn + F.col("deadline")).alias("deadline"),
        ).alias("mix"),
    )


def interleaved(docs: DataFrame, weights: Mapping[str, float] | None = None, **options) -> DataFrame:
    """The rows of ``docs`` in the order of the mixture, with their own columns.

    Written as files, the parts read one after the other give the mixture; they
    are cut by Spark's range partitioning on the slots.
    """
    name = "mix"
    placed = mixed(docs, weights, **options)
    keys = [F.col(f"{name}.slot"), F.col(f"{name}.start")]
    return placed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(name)


def in_file_order(docs: DataFrame) -> DataFrame:
    """``docs`` with the place of each row in its files, in the struct ``mix``.

    The files are taken one after the other, as `interleaved` has them written, whatever
    order they are read in. ``slot`` is the row's number in that order, from 0, and
    ``start`` its first byte among the rows of its source (sizes as in `mixed`). A table
    that is not one of Parquet files is written first. ``mix`` replaces a column of that name.
    """
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        docs = stored(docs, "file-order")
    kept = [column(docs, c) for c in docs.columns if c.lower() != "mix"]
    file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    rows = docs.select(
        F.struct(*kept).alias("doc"),
        F.coalesce(_source(docs), F.lit("-")).alias("source"),
        _size(docs).alias("size"),
        file.alias("file"),
        row.alias("row"),
        F.floor(row / _RUN_ROWS).alias("run"),
    )
    runs = rows.groupBy("file", "run", "source").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    # Numbers of more than five digits would not sort as text.
    part = F.regexp_extract("file", r"part-(\d+)[^/]*$", 1).try_cast("long")

    def before(window, what: str) -> Column:
        return F.coalesce(F.sum(what).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    # A row per file.
    files = runs.groupBy("file").agg(F.sum("n").alias("n"))
    files = files.select("file", before(Window.orderBy(part, "file"), "n").alias("first"))
    offsets = runs.select(
        "file", "run", "source", before(Window.partitionBy("source").orderBy(part, "file", "run"), "bytes").alias("offset")
    ).join(files, "file")
    inside = before(Window.partitionBy("file", "run", "source").orderBy("row"), "size")
    return (
        rows.withColumn("inside", inside)
        .join(offsets, ["file", "run", "source"])
        .select(
            "doc.*",
            F.struct((F.col("first") + F.col("row")).alias("slot"), (F.col("offset") + F.col("inside")).alias("start")).alias("mix"),
        )
    )


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "source", "mix.*"
    )
