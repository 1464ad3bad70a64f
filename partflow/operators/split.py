"""Exact time-based split into train and test rows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow import fixed_values as fv
from partflow.operators.ordering import with_positions

DATE = "transaction_date"
# Rows of one day up to which its order is left to a plain top-n.
ROWS_AT_ONCE = 5_000


@dataclass(frozen=True)
class TimeCut:
    """Where the table is cut: a day, and the last training key of that day.

    ``last`` is ``None`` if all rows of ``day`` are test rows; ``day`` is
    ``None`` for a table without test rows.
    """

    rows: int
    train_rows: int
    day: date | None
    order: tuple[str, ...]
    last: tuple[Any, ...] | None

    @property
    def test_rows(self) -> int:
        return self.rows - self.train_rows

    def is_train(self) -> Column:
        if self.day is None:
            return F.lit(True)
        train = F.col(DATE) < F.lit(self.day)
        if self.last is not None:
            train = train | ((F.col(DATE) == F.lit(self.day)) & self._not_after(0))
        return train

    def _not_after(self, i: int) -> Column:
        """Lexicographic ``order <= last`` from the i-th column on."""
        column, value = F.col(self.order[i]), F.lit(self.last[i])
        if i == len(self.order) - 1:
            return column <= value
        return (column < value) | ((column == value) & self._not_after(i + 1))


def find_cut(
    df: DataFrame,
    order: tuple[str, ...],
    test_share: float = fv.TEST_SHARE,
    rows_at_once: int = ROWS_AT_ONCE,
) -> TimeCut:
    """Locate the cut so that the first ``int(n * (1 - share))`` rows train.

    Rows are ordered by date, then by ``order``, which must identify a row of a
    day. Only counts per day reach the driver; only the one day that the cut
    falls into is ordered: by ranges, unless it has a few rows. A row without a
    date is an error, as it would be neither a train nor a test row.
    """
    if df.filter(F.col(DATE).isNull()).limit(1).count():
        raise ValueError("rows without a date belong to no side of the split")
    days = df.groupBy(DATE).agg(F.count(F.lit(1)).alias("n")).orderBy(DATE).collect()
    total = sum(r["n"] for r in days)
    train_rows = int(total * (1 - test_share))
    before = 0
    for r in days:
        if before + r["n"] > train_rows:
            break
        before += r["n"]
    else:
        return TimeCut(total, train_rows, None, order, None)
    inside = train_rows - before
    last = None
    if inside:
        same_day = df.filter(F.col(DATE) == F.lit(r[DATE])).select(*order)
        if r["n"] <= rows_at_once:
            found = same_day.orderBy(*order).offset(inside - 1).limit(1)
        else:
            found = with_positions(same_day, [], list(order), rows=r["n"]).filter(F.col("_pos") == inside - 1).select(*order)
        last = tuple(found.first())
    return TimeCut(total, train_rows, r[DATE], order, last)


def with_split(df: DataFrame, cut: TimeCut) -> DataFrame:
    """Append ``split``: train or test. A projection, no join."""
    return df.withColumn("split", F.when(cut.is_train(), F.lit("train")).otherwise(F.lit("test")))


def fit_rows(df: DataFrame, cut: TimeCut) -> DataFrame:
    return df.filter(cut.is_train())


def holdout_rows(df: DataFrame, cut: TimeCut) -> DataFrame:
    return df.filter(~cut.is_train())


def split_summary(df: DataFrame, cut: TimeCut) -> DataFrame:
    """Rows and date range of each side."""
    return with_split(df, cut).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(DATE).alias("first_date"),
        F.max(DATE).alias("last_date"),
    )
