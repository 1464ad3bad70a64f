"""Calendar, lag, rolling and category features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow import fixed_values as fv
from partflow.functions.calendar import date_parts
from partflow.operators.ordering import DETECT, ROWS_PER_TASK, hot_keys, windowed
from partflow.operators.quality import signal_flag

PART = "part_number"
DATE = "transaction_date"
QUANTITY = "demand_quantity"


def date_features(df: DataFrame) -> DataFrame:
    return df.withColumns(date_parts(F.col(DATE)))


def lag_columns(spec, lags=fv.LAGS) -> dict[str, Column]:
    """Quantity N rows earlier in the part."""
    return {f"lag_{n}": F.lag(QUANTITY, n).over(spec) for n in lags}


def rolling_columns(spec) -> dict[str, Column]:
    """Statistics of the preceding 7 (and 14) rows, the current one left out."""
    week, fortnight = spec.rowsBetween(-7, -1), spec.rowsBetween(-14, -1)
    return {
        "rolling_mean_7": F.avg(QUANTITY).over(week),
        "rolling_mean_14": F.avg(QUANTITY).over(fortnight),
        "rolling_std_7": F.stddev_samp(QUANTITY).over(week),
        "rolling_min_7": F.min(QUANTITY).over(week),
        "rolling_max_7": F.max(QUANTITY).over(week),
    }


def series_features(
    df: DataFrame,
    ties: tuple[str, ...] = (),
    lags=fv.LAGS,
    rolling: bool = True,
    hot: DataFrame | str | None = DETECT,
    chunk_rows: int = ROWS_PER_TASK,
) -> DataFrame:
    """Lags and rolling statistics per part: one shuffle, one sort, one window.

    ``ties`` complete the order of rows of a part on the same date. ``hot``
    are parts too large for one task (see ``hot_parts``); by default they are
    looked for in ``df``, which a caller who knows them can save.
    """

    def build(spec):
        columns = lag_columns(spec, lags)
        if rolling:
            columns.update(rolling_columns(spec))
        return columns

    back = max([*lags, 14 if rolling else 1])
    return windowed(df, [PART], [DATE, *ties], build, back, hot, chunk_rows)


def hot_parts(df: DataFrame, limit: int = ROWS_PER_TASK) -> DataFrame | None:
    return hot_keys(df.select(PART), [PART], limit)


def category_codes(df: DataFrame) -> DataFrame:
    """Ordinal codes of type and region, -1 for the unknown; signal flag."""

    def coded(column: str, codes: dict[str, int]) -> Column:
        lookup = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
        return F.coalesce(lookup[F.col(column)], F.lit(fv.UNKNOWN_CODE))

    df = df.withColumns(
        {
            "demand_type_encoded": coded("demand_type", fv.DEMAND_TYPE_CODES),
            "region_encoded": coded("region", fv.REGION_CODES),
        }
    )
    return signal_flag(df)


def fill_series_gaps(df: DataFrame) -> DataFrame:
    """Drop each part's first row, then fill the other missing values with 0."""
    kept = df.dropna(subset=["lag_1"])
    return kept.fillna(0, subset=[c for c in df.columns if c.startswith(("rolling_", "lag_"))])


def by_day(df: DataFrame) -> DataFrame:
    """Variant grain: one row per part and day, quantities summed."""
    return df.groupBy(PART, DATE).agg(
        F.sum(QUANTITY).cast("int").alias(QUANTITY),
        F.min("demand_type").alias("demand_type"),
        F.min("region").alias("region"),
        F.avg("unit_cost").alias("unit_cost"),
        F.min("part_description").alias("part_description"),
        F.min("npi_signal").alias("npi_signal"),
    )


def build_features(
    df: DataFrame,
    ties: tuple[str, ...] = (),
    lags=fv.LAGS,
    grain: str = "row",
    hot: DataFrame | str | None = DETECT,
    chunk_rows: int = ROWS_PER_TASK,
) -> DataFrame:
    """The feature table out of validated demand records."""
    if grain == "day":
        df, ties = by_day(df), ()
    df = series_features(date_features(df), ties, lags, True, hot, chunk_rows)
    return fill_series_gaps(category_codes(df))
