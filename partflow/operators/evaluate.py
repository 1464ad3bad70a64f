"""Forecast metrics over keyed prediction rows.

A prediction frame has ``part_number``, ``demand_type``, ``transaction_date``,
tie columns, ``model``, ``actual`` and ``predicted``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partflow import fixed_values as fv
from partflow.functions.numbers import exact_mean, round_even

PART = "part_number"


def prediction_rows(scored: DataFrame, model: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """Keyed long form of one model's scored test rows."""
    return scored.select(
        PART,
        "demand_type",
        "transaction_date",
        *ties,
        F.lit(model).alias("model"),
        F.col(fv.TARGET_COLUMN).cast("double").alias("actual"),
        F.col("predicted").cast("double").alias("predicted"),
    )


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _mae() -> Column:
    return exact_mean(F.abs(F.col("actual") - F.col("predicted")))


def _rmse() -> Column:
    error = F.col("actual") - F.col("predicted")
    return F.sqrt(exact_mean(error * error))


def _mape() -> Column:
    """Mean percentage error over rows with demand; 0 if there are none."""
    demand = F.col("actual") > 0
    share = F.when(demand, F.abs((F.col("actual") - F.col("predicted")) / F.col("actual")))
    return F.coalesce(exact_mean(share) * 100, F.lit(0.0))


def model_metrics(predictions: DataFrame) -> DataFrame:
    """MAE, RMSE and MAPE by model, rounded as they are reported."""
    return predictions.groupBy("model").agg(
        round_even(_mae(), 2).alias("mae"),
        round_even(_rmse(), 2).alias("rmse"),
        round_even(_mape(), 1).alias("mape"),
    )


def part_metrics(predictions: DataFrame, order: tuple[str, ...] = ("transaction_date",)) -> DataFrame:
    """MAE and MAPE by part, with the demand type of its first test row."""
    return predictions.groupBy(PART).agg(
        F.min_by("demand_type", F.struct(*order)).alias("demand_type"),
        round_even(_mae(), 2).alias("mae"),
        round_even(_mape(), 1).alias("mape"),
    )


def improvement(metrics: DataFrame, baseline: str = fv.NAIVE_NAME) -> DataFrame:
    """Percent by which each model beats the baseline; 0 if that has no error.

    The baseline is looked up by a window over the metric rows, one per model,
    so the predictions are aggregated once.
    """
    models = Window.partitionBy(F.lit(0))

    def gain(column: str) -> Column:
        reference = F.max(F.when(F.col("model") == baseline, F.col(column))).over(models)
        return F.coalesce(F.when(reference > 0, (1 - F.col(column) / reference) * 100), F.lit(0.0))

    return metrics.select(
        "model",
        round_even(gain("mae"), 1).alias("mae_improvement"),
        round_even(gain("mape"), 1).alias("mape_improvement"),
    ).filter(F.col("model") != baseline)


def best_models(metrics: DataFrame) -> DataFrame:
    """The winner by MAE and by MAPE; equal errors go to the first name."""

    def winner(metric: str) -> Column:
        return F.min(F.struct(F.col(metric).alias("value"), F.col("model").alias("model")))

    best = metrics.agg(winner("mae").alias("mae"), winner("mape").alias("mape"))
    rows = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m)["model"].alias("model"), F.col(m)["value"].alias("value")) for m in ("mae", "mape")]
    )
    return best.select(F.inline(rows))


def forecast_summary(predictions: DataFrame, part: str | None = None) -> DataFrame:
    """Rows, means and MAE of one model's predictions, optionally of one part."""
    rows = predictions if part is None else predictions.filter(F.col(PART) == part)
    return rows.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        round_even(exact_mean(F.col("actual")), 2).alias("mean_actual"),
        round_even(exact_mean(F.col("predicted")), 2).alias("mean_predicted"),
        round_even(_mae(), 2).alias("mae"),
    )


def sample_predictions(predictions: DataFrame, order: tuple[str, ...], n: int = 10, part: str | None = None) -> DataFrame:
    """The first ``n`` predictions in order, with a 0-based index."""
    rows = predictions if part is None else predictions.filter(F.col(PART) == part)
    first = rows.orderBy(*order).limit(n)
    # At most n rows are left here, so numbering them is one tiny task.
    listed = first.agg(F.sort_array(F.collect_list(F.struct(*order, "actual", "predicted"))).alias("rows"))
    return listed.select(F.posexplode("rows").alias("index", "r")).select("index", "r.*")
