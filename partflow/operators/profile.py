"""Part profiles: demand statistics, trend, volatility, stockout risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partflow import fixed_values as fv
from partflow.functions.numbers import exact_mean, round_even, sample_std, square_sum, whole_sum

PART, DATE, QUANTITY = "part_number", "transaction_date", "demand_quantity"


def _modal_region() -> Column:
    """Most frequent region of the closed vocabulary, first by name on ties.

    Plain conditional counts; no per-group value map is kept.
    """
    counts = {r: F.count(F.when(F.col("region") == r, 1)) for r in sorted(fv.REGIONS)}
    most = F.greatest(*counts.values())
    return F.coalesce(*[F.when(n == most, F.lit(r)) for r, n in counts.items()])


def part_statistics(features: DataFrame, ties: tuple[str, ...] = ()) -> DataFrame:
    """One row of rounded demand statistics per part, over all feature rows.

    Every aggregate has a small fixed-size partial form, so a dominant part
    is folded where its rows are before anything is shuffled.
    """
    n = F.count(F.lit(1))
    q = F.col(QUANTITY).cast("long")
    return features.groupBy(PART).agg(
        F.min_by("demand_type", F.struct(DATE, *ties)).alias("demand_type"),
        _modal_region().alias("region"),
        n.alias("n_days"),
        round_even(F.sum(q) / n, 1).alias("avg_demand"),
        F.max(QUANTITY).alias("max_demand"),
        F.min(QUANTITY).alias("min_demand"),
        round_even(sample_std(n, whole_sum(q), square_sum(q)), 1).alias("std_demand"),
        F.sum(q).alias("total_demand"),
        round_even(exact_mean(F.col("unit_cost")), 2).alias("unit_cost"),
        round_even(exact_mean(F.col("rolling_mean_7")), 1).alias("rolling_mean_7"),
        round_even(exact_mean(F.col("rolling_std_7")), 1).alias("rolling_std_7"),
        F.min(DATE).alias("first_date"),
        F.max(DATE).alias("last_date"),
        F.sum("has_npi_signal").alias("npi_days"),
        round_even(F.sum("has_npi_signal") / n * 100, 1).alias("npi_pct"),
    )


def demand_trend(features: DataFrame, ties: tuple[str, ...] = ()) -> DataFrame:
    """Last 7 rows of a part against the 7 before.

    The rank filter is applied map-side first (a window group limit), so at
    most 14 rows per part and input partition are shuffled.
    """
    newest = Window.partitionBy(PART).orderBy(F.desc(DATE), *[F.desc(c) for c in ties])
    last = features.select(PART, DATE, *ties, QUANTITY).withColumn("_rn", F.row_number().over(newest))
    last = last.filter(F.col("_rn") <= 14)
    sums = last.groupBy(PART).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.when(F.col("_rn") <= 7, F.col(QUANTITY))).alias("_recent"),
        F.sum(F.when(F.col("_rn") > 7, F.col(QUANTITY))).alias("_before"),
    )
    recent, before = F.col("_recent") / 7, F.col("_before") / 7
    change = F.when((F.col("_n") == 14) & (before > 0), round_even((recent - before) / before * 100, 1))
    sums = sums.withColumn("trend_pct", F.coalesce(change, F.lit(0.0)))
    return sums.select(
        PART,
        "trend_pct",
        F.when(F.col("_n") < 14, F.lit(fv.TREND_SHORT))
        .when(F.col("trend_pct") > 5, F.lit("increasing"))
        .when(F.col("trend_pct") < -5, F.lit("decreasing"))
        .otherwise(F.lit("stable"))
        .alias("trend"),
    )


def volatility() -> Column:
    """Class of the coefficient of variation of the *rounded* statistics."""
    cv = F.when(F.col("avg_demand") > 0, F.col("std_demand") / F.col("avg_demand")).otherwise(F.lit(0.0))
    return (
        F.when(cv > 0.5, F.lit(fv.VOLATILITY_HIGH))
        .when(cv > 0.3, F.lit(fv.VOLATILITY_MODERATE))
        .otherwise(F.lit(fv.VOLATILITY_LOW))
    )


def stockout_risk() -> Column:
    """First rule that fits; an unknown MAPE never makes the risk high."""
    rising = F.col("trend") == "increasing"
    return (
        F.when(rising & F.coalesce(F.col("mape") > 50, F.lit(False)), F.lit(fv.RISK_HIGH))
        .when(rising, F.lit(fv.RISK_MODERATE_TREND))
        .when(F.col("volatility").startswith("high"), F.lit(fv.RISK_MODERATE_VOLATILE))
        .otherwise(F.lit(fv.RISK_LOW))
    )


def stock_advice() -> Column:
    return (
        F.when(F.col("stockout_risk") == "HIGH", F.lit(fv.ADVICE_HIGH))
        .when(F.col("stockout_risk") == "MODERATE", F.lit(fv.ADVICE_MODERATE))
        .otherwise(F.lit(fv.ADVICE_LOW))
    )


def part_profiles(features: DataFrame, metrics: DataFrame | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """Statistics, trend and risk per part; ``metrics`` has MAE/MAPE by part.

    All three inputs are one row per part and hashed on it, so the joins add
    no shuffle of detail rows.
    """
    profile = part_statistics(features, ties).join(demand_trend(features, ties), PART)
    if metrics is None:
        profile = profile.withColumns({"mae": F.lit(None).cast("double"), "mape": F.lit(None).cast("double")})
    else:
        profile = profile.join(metrics.select(PART, "mae", "mape"), PART, "left")
    return (
        profile.withColumn("volatility", volatility())
        .withColumn("risk_text", stockout_risk())
        .withColumn("stockout_risk", F.split("risk_text", " —")[0])
        .withColumn("advice", stock_advice())
    )
