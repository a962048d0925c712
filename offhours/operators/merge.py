"""De-duplication, upserts and day replacement."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offhours.session import materialize


def keep_one(df: DataFrame, keys: Sequence[str], prefer: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the least by ``prefer``, then by all other columns.

    A ``min`` over a struct instead of a ranking window: copies collapse before
    the shuffle, so a key that holds a third of all rows does not end up in one
    task, and the choice does not depend on partitioning.
    """
    columns = df.columns
    rest = [c for c in columns if c not in keys]
    order = [p.alias(f"_p{i}") for i, p in enumerate(prefer)]
    if not (rest or order):
        return df.distinct()
    kept = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_kept"))
    return kept.selectExpr(*[f"`{c}`" if c in keys else f"_kept.`{c}` AS `{c}`" for c in columns])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in the order of the named columns."""
    return keep_one(df, keys, [F.col(c) for c in order])


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality of the keys in which a null equals a null, as in de-duplication."""
    return reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in keys])


def new_only(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``, one per key.

    ``new`` is computed once and kept. The range of its first key becomes literal
    bounds on the large table, which reach its scan: files and row groups whose
    keys lie outside are not read, so where keys grow with time (as ids of a feed
    do) a day is compared with little more than itself. Of the rest only the key
    column is read, and the final anti-join is between small tables.
    """
    new = materialize(keep_one(new, keys))
    key = F.col(keys[0])
    low, high, nulls = new.agg(F.min(key), F.max(key), F.count_if(key.isNull())).first()
    within = key.between(F.lit(low), F.lit(high)) if low is not None else F.lit(False)
    wanted = new.select(*keys)
    present = existing.select(*keys).where(within | key.isNull() if nulls else within)
    hits = present.join(wanted, same_key(present, wanted, keys), "left_semi").distinct()
    return new.join(hits, same_key(new, hits, keys), "left_anti")


def upsert_existing_wins(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both tables by column name, one row per key, existing rows first."""
    both = existing.withColumn("_source", F.lit(0)).unionByName(
        new.withColumn("_source", F.lit(1))
    )
    return keep_one(both, keys, [F.col("_source")]).drop("_source")


def replace_day(existing: DataFrame, recomputed: DataFrame, ts: str, day: str) -> DataFrame:
    """``existing`` with the rows of one day exchanged for ``recomputed``.

    Columns that one side lacks are filled with null. Running it again with the
    same input changes nothing.
    """
    # Rows without a timestamp are of no day and stay.
    kept = existing.where(~F.to_date(ts).eqNullSafe(F.lit(day).cast("date")))
    return kept.unionByName(recomputed, allowMissingColumns=True)


def days_around(df: DataFrame, ts: str, day: str, days_before: int) -> DataFrame:
    """Rows from midnight ``days_before`` days earlier to the end of ``day``.

    Plain comparisons with literals, so the bounds reach the Parquet scan.
    """
    end = F.expr(f"timestamp'{day}' + interval 1 day")
    start = F.expr(f"timestamp'{day}' - interval {int(days_before)} days")
    kind = dict(df.dtypes)[ts]
    return df.where((F.col(ts) >= start.cast(kind)) & (F.col(ts) < end.cast(kind)))
