"""Exact ranks and quantiles of arbitrary values, without one-task sorts.

Equal values are first counted together (map-side), so a value that a third of
the rows share is one row from then on. The distinct values are range-partitioned
by Spark, which samples them for even parts whatever their distribution; the
offset of each part is a running sum over a table with one row per part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offhours.session import materialize


def counted_order(
    df: DataFrame, by: Sequence[str], value: str, weight: str | None = None
) -> DataFrame:
    """Distinct ``value`` per ``by`` group, placed in the order of its group.

    ``n`` is the number of rows with the value (or their summed ``weight``),
    ``n_below`` of those with a smaller one, ``n_total`` of the whole group.

    The placement is materialised: offsets and rows must see the same parts, and
    range boundaries are sampled anew on each evaluation.
    """
    size = F.sum(weight) if weight else F.count(F.lit(1))
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(size.alias("n"))
    placed = materialize(
        counted.repartitionByRange(*by, value).withColumn("_part", F.spark_partition_id())
    )
    # At most one row per part and group.
    in_part = placed.groupBy(*by, "_part").agg(F.sum("n").alias("_n"))
    whole = Window.partitionBy(*by)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = in_part.select(
        *by,
        "_part",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_n").over(whole).alias("n_total"),
    )
    inside = (
        Window.partitionBy(*by, "_part")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        placed.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(offsets, [*by, "_part"])
        .select(
            *by, value, "n", (F.col("_offset") + F.col("_inside")).alias("n_below"), "n_total"
        )
    )


def centred_ranks(
    df: DataFrame, by: Sequence[str], value: str, out: str, weight: str | None = None
) -> DataFrame:
    """Rank of each distinct value minus the mean rank; ties share their mean rank."""
    ordered = counted_order(df, by, value, weight)
    rank = F.col("n_below") + (F.col("n") + 1) / 2
    return ordered.select(*by, value, (rank - (F.col("n_total") + 1) / 2).alias(out))


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, quantiles: dict[str, float]
) -> DataFrame:
    """Linearly interpolated quantiles per group, one column per entry.

    A quantile needs the values at two neighbouring places of the order; each is
    picked by a conditional maximum, so the last step combines map-side too.
    """
    ordered = counted_order(df, by, value)

    def at(place):
        here = (F.col("n_below") <= place) & (place < F.col("n_below") + F.col("n"))
        return F.max(F.when(here, F.col(value)))

    picks = []
    for name, q in quantiles.items():
        place = F.lit(float(q)) * (F.col("n_total") - 1)
        picks += [
            at(F.floor(place)).alias(f"_{name}_lo"),
            at(F.ceil(place)).alias(f"_{name}_hi"),
            F.max(place - F.floor(place)).alias(f"_{name}_share"),
        ]
    picked = ordered.groupBy(*by).agg(*picks)
    return picked.select(
        *by,
        *[
            (
                F.col(f"_{name}_lo")
                + (F.col(f"_{name}_hi") - F.col(f"_{name}_lo")) * F.col(f"_{name}_share")
            ).alias(name)
            for name in quantiles
        ],
    )
