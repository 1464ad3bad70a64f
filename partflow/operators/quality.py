"""Quality flags and data set summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partflow.functions.numbers import round_even, sample_std, square_sum, whole_sum


def signal_flag(df: DataFrame) -> DataFrame:
    """1 where the row has a signal; a frame that has the flag keeps it."""
    if "has_npi_signal" in df.columns:
        return df
    return df.withColumn("has_npi_signal", F.col("npi_signal").isNotNull().cast("int"))


def outlier_limit(df: DataFrame, column: str = "demand_quantity") -> DataFrame:
    """One row: mean + 3 sample deviations, null if undefined or no spread."""
    q = F.col(column).cast("long")
    sums = df.agg(F.count(q).alias("n"), whole_sum(q).alias("s"), square_sum(q).alias("ss"))
    std = sample_std(F.col("n"), F.col("s"), F.col("ss"))
    return sums.select(F.when(std > 0, F.col("s").cast("double") / F.col("n") + 3 * std).alias("outlier_limit"))


def quality_flags(df: DataFrame) -> DataFrame:
    """Zero-demand, outlier and signal flags.

    The limit is a scalar subquery: one aggregate over the quantity column,
    whose single value is then a constant of the projection.
    """
    limit = outlier_limit(df).scalar()
    q = F.col("demand_quantity")
    flagged = df.withColumns(
        {
            "is_zero_demand": F.coalesce((q == 0).cast("int"), F.lit(0)),
            "is_demand_outlier": F.coalesce((q > limit).cast("int"), F.lit(0)),
        }
    )
    return signal_flag(flagged)


def null_cells(columns: list[str]) -> Column:
    """Number of nulls of a row over the given columns."""
    total = F.lit(0)
    for c in columns:
        total = total + F.col(c).isNull().cast("int")
    return total


def dataset_summary(df: DataFrame) -> DataFrame:
    """One row of totals.

    Rows are first folded to one per (part, region), so the distinct counts
    work on that small table instead of a doubled copy of the data.
    """
    data_columns = df.columns
    folded = df.groupBy("part_number", "region").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("transaction_date").alias("d0"),
        F.max("transaction_date").alias("d1"),
        F.sum("is_zero_demand").alias("z"),
        F.sum("is_demand_outlier").alias("o"),
        F.sum("has_npi_signal").alias("p"),
        F.sum(null_cells(data_columns)).alias("nulls"),
    )
    return folded.agg(
        F.sum("n").alias("total_records"),
        F.min("d0").alias("first_date"),
        F.max("d1").alias("last_date"),
        F.count_distinct("part_number").alias("unique_parts"),
        F.count_distinct("region").alias("unique_regions"),
        F.sum("z").alias("zero_demand_rows"),
        F.sum("o").alias("outlier_rows"),
        F.sum("p").alias("signal_rows"),
        F.sum("nulls").alias("null_values"),
    )


def value_share(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a closed vocabulary, with the share in percent.

    The total is a window over the counts: a handful of rows, and the data is
    read once.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy(F.lit(0)))
    share = round_even(F.col("n_rows") / total * 100, 1)
    return counts.withColumn("share_pct", share).orderBy(F.desc("n_rows"), column)
