"""Ordered operators on a time series, spread over many tasks.

A window without a partition key sorts the whole series in one task. Here each
operator works inside calendar days, in parallel, and brings over what a day
needs from other days with a table of one row per day.

Why this holds at scale: the series has one row per timestamp (candles and slots
are de-duplicated or aggregated first), so a day holds at most 86,400 rows at
one-second resolution, however many raw events stand behind them. The per-day
table is bounded by the calendar, about 11,000 rows for thirty years; only that
table is ever ordered as a whole. A series finer than a second takes shorter
buckets than a day (``bucket_seconds``); buckets are then ordered inside their
days, and days among one another, so the one-task table stays one row per day.

Except for ``rolling`` and ``next_open``, the operators read their input twice,
once for the rows and once for the per-day table, so it should be a stored table
rather than a long plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offhours.functions.moments import bucket_number

_DAY = "_day"
_LOOSE = "_loose"
DAY_SECONDS = 86_400
# Groups over which rows without a place in the series are spread.
LOOSE_GROUPS = 4096


def _days(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys).orderBy(_DAY) if keys else Window.orderBy(_DAY)


def _in_days(df: DataFrame, ts: str, keys: Sequence[str], bucket_seconds: int) -> tuple[DataFrame, Window]:
    """``df`` with the day of each row, and the window over each day in time order.

    Rows without a timestamp have no neighbours, and all of them in one group would be one
    task's work; they are dealt over many groups.
    """
    loose = F.pmod(F.monotonically_increasing_id(), F.lit(LOOSE_GROUPS))
    df = df.withColumn(_DAY, bucket_number(ts, bucket_seconds)).withColumn(
        _LOOSE, F.when(F.col(ts).isNull(), loose)
    )
    return df, Window.partitionBy(*keys, _DAY, _LOOSE).orderBy(ts)


def _neighbour(
    per_bucket: DataFrame, value: Column, keys: Sequence[str], bucket_seconds: int, before: bool
) -> DataFrame:
    """``_carried``: ``value`` of the bucket before (or after) each one, among those there are."""
    step = F.lag if before else F.lead
    rows = per_bucket.select(*keys, _DAY, value.alias("_value"))
    if bucket_seconds >= DAY_SECONDS:
        return rows.select(*keys, _DAY, step("_value").over(_days(keys)).alias("_carried"))
    calendar = F.floor(F.col(_DAY) * bucket_seconds / DAY_SECONDS).cast("long")
    rows = rows.withColumn("_calendar", calendar)
    inside = Window.partitionBy(*keys, "_calendar").orderBy(_DAY)
    edge = (F.max if before else F.min)(F.struct(_DAY, "_value"))
    whole = Window.partitionBy(*keys).orderBy("_calendar") if keys else Window.orderBy("_calendar")
    per_day = rows.groupBy(*keys, "_calendar").agg(edge.alias("_edge")).select(
        *keys, "_calendar", step("_edge._value").over(whole).alias("_from_day")
    )
    return (
        rows.withColumn("_other", step(_DAY).over(inside))
        .withColumn("_inside", step("_value").over(inside))
        .join(per_day, [*keys, "_calendar"], "left")
        .select(
            *keys,
            _DAY,
            F.when(F.col("_other").isNull(), F.col("_from_day"))
            .otherwise(F.col("_inside"))
            .alias("_carried"),
        )
    )


def lag_in_time(
    df: DataFrame,
    ts: str,
    value: str,
    out: str,
    keys: Sequence[str] = (),
    bucket_seconds: int = DAY_SECONDS,
) -> DataFrame:
    """Add ``out``: ``value`` of the row before, null on the first row.

    The first row of a day takes the last value of the latest earlier day that
    has rows. Rows without a timestamp get null and are nobody's neighbours.
    """
    df, inside = _in_days(df, ts, keys, bucket_seconds)
    dated = df.where(F.col(_DAY).isNotNull())
    last_of_day = dated.groupBy(*keys, _DAY).agg(F.max(F.struct(ts, value)).alias("_last"))
    carried = _neighbour(last_of_day, F.col(f"_last.{value}"), keys, bucket_seconds, before=True)
    neighbour = F.when(F.col("_pos") == 1, F.col("_carried")).otherwise(F.col("_inside"))
    return (
        df.withColumn("_pos", F.row_number().over(inside))
        .withColumn("_inside", F.lag(value).over(inside))
        .join(carried, [*keys, _DAY], "left")
        .withColumn(out, F.when(F.col(ts).isNotNull(), neighbour))
        .drop(_DAY, _LOOSE, "_pos", "_inside", "_carried")
    )


def lead_in_time(
    df: DataFrame,
    ts: str,
    values: Sequence[str],
    out: str,
    keys: Sequence[str] = (),
    bucket_seconds: int = DAY_SECONDS,
) -> DataFrame:
    """Add struct ``out``: timestamp and ``values`` of the row after, null on the last.

    Rows without a timestamp get null and are nobody's neighbours.
    """
    df, inside = _in_days(df, ts, keys, bucket_seconds)
    payload = F.struct(ts, *values)
    dated = df.where(F.col(_DAY).isNotNull())
    first_of_day = dated.groupBy(*keys, _DAY).agg(F.min(payload).alias("_first"))
    carried = _neighbour(first_of_day, F.col("_first"), keys, bucket_seconds, before=False)
    return (
        df.withColumn("_inside", F.lead(payload).over(inside))
        .join(carried, [*keys, _DAY], "left")
        .withColumn(out, F.when(F.col(ts).isNotNull(), F.coalesce("_inside", "_carried")))
        .drop(_DAY, _LOOSE, "_inside", "_carried")
    )


def next_open(
    timeline: DataFrame,
    opens: DataFrame,
    ts: str = "master_datetime",
    flag: str = "market_open",
    open_ts: str = "Datetime",
    out: str = "target_open_datetime",
    bucket_seconds: int = DAY_SECONDS,
) -> DataFrame:
    """Add ``out``: the earliest open timestamp at or after the row's own.

    ``opens`` lists the open timestamps. It is passed apart from the timeline so
    that the per-day table comes from the small market series instead of a
    second pass over the events. Rows after the last open timestamp get null.
    """
    inside = (
        Window.partitionBy(_DAY)
        .orderBy(F.col(ts).desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    first_open = (
        opens.where(F.col(open_ts).isNotNull())
        .withColumn(_DAY, bucket_number(open_ts, bucket_seconds))
        .groupBy(_DAY)
        .agg(F.min(open_ts).alias("_later_open"))
    )
    # A day's first open serves every day since the one that last had an open.
    # Days before the first open day are met by the overall first open below.
    since = _neighbour(first_open, F.col(_DAY), (), bucket_seconds, before=True)
    served = first_open.join(since, _DAY).select(
        F.explode(F.sequence(F.coalesce("_carried", F.col(_DAY) - 1), F.col(_DAY) - 1)).alias(_DAY),
        "_later_open",
    )
    very_first = opens.agg(F.min(open_ts).alias("_first")).scalar()
    return (
        timeline.withColumn(_DAY, bucket_number(ts, bucket_seconds))
        .withColumn("_same_day", F.min(F.when(F.col(flag) == 1, F.col(ts))).over(inside))
        .join(served, _DAY, "left")
        .withColumn("_very_first", very_first)
        .withColumn(
            out,
            F.coalesce(
                "_same_day",
                "_later_open",
                F.when(F.col(ts) <= F.col("_very_first"), F.col("_very_first")),
            ),
        )
        .drop(_DAY, "_same_day", "_later_open", "_very_first")
    )


def _rows_before(per_bucket: DataFrame, keys: Sequence[str], bucket_seconds: int) -> DataFrame:
    """``_before``: the rows (``_n``) of all earlier buckets."""

    def running(order: Window) -> Column:
        earlier = order.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(earlier), F.lit(0))

    if bucket_seconds >= DAY_SECONDS:
        return per_bucket.select(*keys, _DAY, running(_days(keys)).alias("_before"))
    calendar = F.floor(F.col(_DAY) * bucket_seconds / DAY_SECONDS).cast("long")
    rows = per_bucket.withColumn("_calendar", calendar)
    whole = Window.partitionBy(*keys).orderBy("_calendar") if keys else Window.orderBy("_calendar")
    per_day = rows.groupBy(*keys, "_calendar").agg(F.sum("_n").alias("_n")).select(
        *keys, "_calendar", running(whole).alias("_earlier_days")
    )
    inside = Window.partitionBy(*keys, "_calendar").orderBy(_DAY)
    return (
        rows.withColumn("_inside", running(inside))
        .join(per_day, [*keys, "_calendar"])
        .select(*keys, _DAY, (F.col("_earlier_days") + F.col("_inside")).alias("_before"))
    )


def with_position(
    df: DataFrame,
    ts: str,
    out: str = "_pos",
    keys: Sequence[str] = (),
    bucket_seconds: int = DAY_SECONDS,
) -> DataFrame:
    """Add ``out``: 0-based position of the row in time order over the whole series.

    Rows without a timestamp have no place in it: their position is null.
    """
    df, inside = _in_days(df, ts, keys, bucket_seconds)
    placed = df.where(F.col(_DAY).isNotNull())
    per_day = placed.groupBy(*keys, _DAY).agg(F.count(F.lit(1)).alias("_n"))
    before = _rows_before(per_day, keys, bucket_seconds)
    return (
        df.withColumn("_inside", F.row_number().over(inside))
        .join(before, [*keys, _DAY], "left")
        .withColumn(out, F.when(F.col(ts).isNotNull(), F.col("_before") + F.col("_inside") - 1))
        .drop(_DAY, _LOOSE, "_inside", "_before")
    )


def rolling(
    df: DataFrame,
    position: str,
    preceding: int,
    columns: dict[str, object],
    keys: Sequence[str] = (),
    bucket_rows: int | None = None,
) -> DataFrame:
    """Add window columns over the ``preceding`` rows before each row and itself.

    ``columns`` maps a new column to a function from a window to a Column. The
    series is cut into buckets of equal row count by ``position``; the last
    ``preceding`` rows of a bucket are also sent to the next one, which is all
    the history its first rows need. With the default bucket length an eighth
    of the rows travels twice. Rows without a position get null in the new columns.

    Any aggregate will do, but Spark works a sliding frame out anew for each row:
    ``preceding + 1`` updates a row. `rolling_measures` needs two.
    """
    length = bucket_rows or 8 * max(preceding, 1)
    if length < preceding:
        raise ValueError("a bucket must hold at least the rows a window looks back on")
    home = F.floor(F.col(position) / F.lit(length)).cast("long")
    needed_later = F.pmod(F.col(position), F.lit(length)) >= F.lit(length - preceding)
    known = F.col(position).isNotNull()
    # Rows without a position only have to be somewhere: not all in one bucket.
    anywhere = F.array(-1 - F.pmod(F.monotonically_increasing_id(), F.lit(LOOSE_GROUPS)))
    copies = (
        F.when(~known, anywhere)
        .when(needed_later, F.array(home, home + 1))
        .otherwise(F.array(home))
    )
    frame = Window.partitionBy(*keys, "_bucket").orderBy(position).rowsBetween(-preceding, 0)
    placed = df.withColumn("_bucket", F.explode(copies))
    for name, build in columns.items():
        placed = placed.withColumn(name, F.when(known, build(frame)))
    return placed.where(~known | (F.col("_bucket") == home)).drop("_bucket")


def rolling_measures(
    df: DataFrame,
    position: str,
    preceding: int,
    measures: dict[str, tuple[str, str]],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Add measures over the ``preceding`` positions before each row and its own, at constant work a row.

    ``measures`` maps a new column to a kind (``min``, ``max``, ``count``, ``sum``, ``mean``
    or ``std``, the sample deviation) and the column it is taken of; nulls in that are left out.
    Positions are whole numbers, each taken once per ``keys``. Rows without one get null.

    The series is cut into blocks as long as the window. A window is then the end of one
    block and the beginning of the next, so what is needed are running measures from the end
    of each block backwards and from its beginning forwards: two updates a row, however long
    the window is. Sums and squares of the two halves are added, never subtracted, so a
    large value leaves no rounding errors behind when it has left the window.
    """
    block = F.floor(F.col(position) / F.lit(preceding + 1)).cast("long")
    known = F.col(position).isNotNull()
    anywhere = -1 - F.pmod(F.monotonically_increasing_id(), F.lit(LOOSE_GROUPS))

    def copy(to: Column, past: bool) -> Column:
        return F.struct(to.alias("block"), F.lit(past).alias("past"))

    copies = F.when(known, F.array(copy(block, False), copy(block + 1, True))).otherwise(
        F.array(copy(anywhere, False))
    )
    placed = df.withColumn("_copy", F.explode(copies))
    past = F.col("_copy.past")
    group = [*keys, "_copy.block"]
    so_far = (Window.unboundedPreceding, Window.currentRow)
    forwards = Window.partitionBy(*group).orderBy(position).rowsBetween(*so_far)
    # A row of the block before counts for the rows up to ``preceding`` places behind it.
    reach = F.col(position) + F.when(past, F.lit(preceding)).otherwise(F.lit(0))
    backwards = Window.partitionBy(*group).orderBy(reach.desc(), past.desc()).rowsBetween(*so_far)

    def halves(aggregate, value: Column) -> tuple[Column, Column]:
        return (
            aggregate(F.when(past, value)).over(backwards),
            aggregate(F.when(known & ~past, value)).over(forwards),
        )

    def measure(kind: str, name: str) -> Column:
        value = F.col(name)
        if kind == "min":
            return F.least(*halves(F.min, value))
        if kind == "max":
            return F.greatest(*halves(F.max, value))
        n_old, n_new = halves(F.count, value)
        if kind == "count":
            return n_old + n_new
        if kind == "sum":
            old, new = halves(F.sum, value)
            return F.coalesce(old + new, old, new)
        value = value.cast("double")
        if kind == "mean":
            old, new = halves(F.sum, value)
            return F.try_divide(F.coalesce(old + new, old, new), n_old + n_new)
        if kind == "std":
            return _joined_deviation(n_old, n_new, *halves(F.avg, value), *halves(F.var_pop, value))
        raise ValueError(f"unknown measure {kind!r}")

    # All at once, so that Spark needs one sort for each direction.
    found = {name: F.when(known, measure(kind, of)) for name, (kind, of) in measures.items()}
    return placed.withColumns(found).where(~past).drop("_copy")


def _joined_deviation(
    n_a: Column, n_b: Column, mean_a: Column, mean_b: Column, var_a: Column, var_b: Column
) -> Column:
    """Sample deviation of two sets together, from number, mean and variance of each."""
    n = n_a + n_b
    apart = mean_b - mean_a
    between = F.when((n_a > 0) & (n_b > 0), apart * apart * n_a * n_b / n).otherwise(F.lit(0.0))
    inside = F.coalesce(var_a * n_a, F.lit(0.0)) + F.coalesce(var_b * n_b, F.lit(0.0))
    return F.when(n > 1, F.sqrt((inside + between) / (n - 1)))


def fill_between(
    df: DataFrame,
    ts: str,
    values: Sequence[str],
    step_seconds: Column | int,
    keys: Sequence[str] = (),
    linear: bool = False,
    bucket_seconds: int = DAY_SECONDS,
) -> DataFrame:
    """Add the missing steps between the first and the last row of a series.

    Each row is expanded up to the next one. Added rows hold null, or with
    ``linear`` the straight line between the two neighbours; ``filled`` marks
    them.
    """
    step = step_seconds if isinstance(step_seconds, Column) else F.lit(step_seconds)
    following = lead_in_time(df, ts, values, "_next", keys, bucket_seconds)
    here, there = F.unix_seconds(F.col(ts)), F.unix_seconds(F.col(f"_next.{ts}"))
    last_step = F.coalesce(F.floor((there - here - 1) / step), F.lit(0)).cast("long")
    spread = (
        following.withColumn("_last_step", last_step)
        .withColumn("_step", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last_step"))))
        .withColumn("filled", F.col("_step") > 0)
    )
    share = F.col("_step") * step / (there - here)

    def value(name: str) -> Column:
        added = F.lit(None).cast("double")
        if linear:
            added = F.col(name) + (F.col(f"_next.{name}") - F.col(name)) * share
        return F.when(F.col("filled"), added).otherwise(F.col(name)).alias(name)

    return spread.select(
        *keys,
        F.timestamp_seconds(here + F.col("_step") * step).alias(ts),
        *[value(name) for name in values],
        "filled",
    )
