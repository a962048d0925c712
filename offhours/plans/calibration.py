"""Grid search for the weight of the peak in the smoothed score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offhours.functions.market import hybrid
from offhours.functions.significance import p_value
from offhours.operators.merge import keep_first
from offhours.operators.ranking import centred_ranks
from offhours.session import materialize

_MEASURES = [
    "Datetime",
    "gap_duration_15m",
    "geo_score_raw_max",
    "geo_score_raw_sum",
    "Variation_Pct",
]


def reopenings(gold: DataFrame, dedup: bool = True) -> DataFrame:
    """Candles after a closure, complete cases only, with peak, mean and change.

    Only there do peak and mean differ. ``dedup`` undoes the split by country;
    without it a candle counts once per country.
    """
    measures = gold.select(*_MEASURES)
    if dedup:
        measures = keep_first(measures, ["Datetime"], [])
    return (
        measures.where(F.col("gap_duration_15m") > 1)
        .select(
            F.col("geo_score_raw_max").alias("peak"),
            F.try_divide("geo_score_raw_sum", "gap_duration_15m").alias("mean"),
            F.col("Variation_Pct").alias("change"),
        )
        .dropna()
    )


def alpha_grid(
    gold: DataFrame, steps: int = 20, dedup: bool = True, absolute: bool = False
) -> DataFrame:
    """Spearman correlation of hybrid score and price change for each alpha.

    ``absolute`` correlates with the size of the change instead. Rows that agree
    in (alpha, score, change) are counted together before the ranks are joined
    on, and the correlation of the ranks is taken from weighted sums; so equal
    scores, such as the zeros of eventless closures, are one row each.
    """
    change = F.abs("change") if absolute else F.col("change")
    alpha = F.round(F.col("_step") / F.lit(steps), 4)
    points = materialize(
        reopenings(gold, dedup)
        .withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(steps))))
        .select(
            alpha.alias("alpha"),
            hybrid("peak", "mean", alpha).alias("score"),
            change.alias("change"),
        )
        .groupBy("alpha", "score", "change")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    # Every alpha pairs the same changes; those of one are ranked along with the
    # scores, as a group of their own, so that all values are placed once.
    changes = points.where("alpha = 0").select(F.lit(-1.0).alias("alpha"), "change", "copies")
    values = points.select("alpha", F.col("score").alias("value"), "copies").union(changes)
    ranks = centred_ranks(values, ["alpha"], "value", "rank", "copies")
    score_rank = ranks.where("alpha >= 0").select(
        "alpha", F.col("value").alias("score"), F.col("rank").alias("x")
    )
    change_rank = ranks.where("alpha < 0").select(
        F.col("value").alias("change"), F.col("rank").alias("y")
    )
    ranked = points.join(score_rank, ["alpha", "score"]).join(change_rank, ["change"])

    def weighted(a: str, b: str):
        return F.sum(F.col("copies") * F.col(a) * F.col(b))

    rho = F.try_divide(weighted("x", "y"), F.sqrt(weighted("x", "x") * weighted("y", "y")))
    grid = ranked.groupBy("alpha").agg(F.sum("copies").alias("n"), rho.alias("spearman_rho"))
    return grid.withColumn("abs_rho", F.abs("spearman_rho"))


def with_significance(grid: DataFrame) -> DataFrame:
    """Add the t statistic of the correlation and its two-sided p-value."""
    freedom = F.col("n") - 2
    rho = F.col("spearman_rho")
    t = F.when(F.abs(rho) >= 1, rho * float("inf")).otherwise(
        rho * F.sqrt(F.try_divide(freedom, (1 - rho) * (1 + rho)))
    )
    return grid.withColumn("t", t).withColumn("p_value", p_value("t", freedom.cast("double")))


def best_alphas(grid: DataFrame, size: int = 5) -> DataFrame:
    """Strongest correlations first; ties in alpha order."""
    return grid.orderBy(F.desc_nulls_last("abs_rho"), "alpha").limit(size)


def calibrate_alpha(grid: DataFrame, current_alpha: float = 0.80) -> DataFrame:
    """One row: the best alpha, and its gain over the current one; none where the grid has none."""
    strongest = F.max(F.struct("abs_rho", (-F.col("alpha")).alias("_tie"), "alpha", "spearman_rho"))
    is_current = F.abs(F.col("alpha") - current_alpha) < 1e-9
    current = F.max(F.when(is_current, F.col("spearman_rho")))
    # An aggregate of no rows is a row of nulls.
    best = grid.agg(strongest.alias("_best"), current.alias("current_rho")).where("_best IS NOT NULL")
    return best.select(
        F.col("_best.alpha").alias("alpha"),
        F.col("_best.spearman_rho").alias("spearman_rho"),
        "current_rho",
        (F.col("_best.abs_rho") - F.abs("current_rho")).alias("gain"),
    )
