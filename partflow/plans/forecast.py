"""Validated records to features, predictions and metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from partflow import fixed_values as fv
from partflow.operators.evaluate import best_models, improvement, model_metrics, part_metrics, prediction_rows, stack
from partflow.operators.features import build_features, hot_parts
from partflow.operators.models.boosted import BoostedForecaster
from partflow.operators.models.naive import predict_naive
from partflow.operators.models.seasonal import fit_seasonal, predict_seasonal
from partflow.operators.ordering import DETECT, ROWS_PER_TASK
from partflow.operators.split import TimeCut, find_cut, fit_rows, holdout_rows
from partflow.session import materialize
from partflow.sources.tables import write_csv, write_table


@dataclass(frozen=True)
class Forecast:
    features: DataFrame
    cut: TimeCut
    states: DataFrame
    booster: BoostedForecaster | None
    predictions: DataFrame
    metrics: DataFrame
    part_metrics: DataFrame


def split_order(ties: tuple[str, ...]) -> tuple[str, ...]:
    """Order of the rows of one day."""
    return ("part_number", *ties)


def seasonal_forecast(features: DataFrame, cut: TimeCut, ties=(), hot: DataFrame | str | None = DETECT, **params):
    """Fit on the training rows, predict the test rows: (states, scored)."""
    states = fit_seasonal(fit_rows(features, cut), ties, hot=hot, **params)
    return states, predict_seasonal(holdout_rows(features, cut), states)


def boosted_forecast(features: DataFrame, cut: TimeCut, **params):
    """Train and predict with the boosted trees: (model, scored)."""
    booster = BoostedForecaster(**params).train(fit_rows(features, cut))
    return booster, booster.predict(holdout_rows(features, cut))


def run_forecast(
    valid: DataFrame,
    output_dir: str | None = None,
    ties: tuple[str, ...] = (),
    boosted: bool = True,
    rows_per_task: int = ROWS_PER_TASK,
    csv: bool = True,
    **booster_params,
) -> Forecast:
    """Features once, one split for all models, keyed predictions, metrics."""
    hot = hot_parts(valid, rows_per_task)
    features = materialize(build_features(valid, ties, hot=hot, chunk_rows=rows_per_task), "features")
    cut = find_cut(features, split_order(ties))
    states = fit_seasonal(fit_rows(features, cut), ties)
    states = materialize(states, "seasonal-states")
    seasonal = predict_seasonal(holdout_rows(features, cut), states)
    scored = [
        prediction_rows(seasonal, fv.SEASONAL_NAME, ties),
        prediction_rows(predict_naive(holdout_rows(features, cut)), fv.NAIVE_NAME, ties),
    ]
    booster = None
    if boosted:
        booster, done = boosted_forecast(features, cut, **booster_params)
        scored.insert(0, prediction_rows(done, fv.BOOSTED_NAME, ties))
    predictions = materialize(stack(scored), "predictions")
    metrics = model_metrics(predictions)
    lead = fv.BOOSTED_NAME if boosted else fv.SEASONAL_NAME
    parts = part_metrics(predictions.filter(predictions["model"] == lead), ("transaction_date", *ties))
    if output_dir:
        write_table(features, f"{output_dir}/features", "demand_type")
        write_table(predictions, f"{output_dir}/predictions", "model")
        write_table(states, f"{output_dir}/seasonal_states")
        write_table(metrics, f"{output_dir}/model_comparison")
        if csv:
            write_csv(features, f"{output_dir}/features_csv")
            write_csv(predictions, f"{output_dir}/predictions_csv")
            write_csv(metrics, f"{output_dir}/model_comparison_csv")
        if booster is not None:
            booster.save(f"{output_dir}/boosted_model")
    return Forecast(features, cut, states, booster, predictions, metrics, parts)


def comparison(metrics: DataFrame) -> dict[str, DataFrame]:
    return {"metrics": metrics, "improvement": improvement(metrics), "best": best_models(metrics)}
