"""Naive forecast: the previous quantity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.operators.ordering import ROWS_PER_TASK, windowed_whole


def predict_naive(test: DataFrame) -> DataFrame:
    """The lag-1 feature is the prediction."""
    return test.withColumn("predicted", F.col("lag_1").cast("double"))


def predict_previous_row(
    test: DataFrame,
    order: list[str],
    first: str = "zero",
    chunk_rows: int = ROWS_PER_TASK,
    rows: int | None = None,
) -> DataFrame:
    """Fallback without a lag feature: the previous row of the whole test set.

    The first row, which has none, gets 0 or (``first="own"``) its own value.
    """
    fill = F.lit(0) if first == "zero" else F.col("demand_quantity")

    def build(spec):
        return {"predicted": F.coalesce(F.lag("demand_quantity", 1).over(spec), fill).cast("double")}

    return windowed_whole(test, order, build, 1, chunk_rows, rows)
