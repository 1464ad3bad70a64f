"""Listings and summary cards over chunks, features and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.functions.numbers import round_even, sample_std, square_sum, whole_sum
from partflow.operators.narrate import PART_SOURCE


def part_chunks_only(chunks: DataFrame, demand_type: str | None = None) -> DataFrame:
    """Chunks of parts, optionally of one demand type."""
    parts = chunks.filter(F.col("source") == PART_SOURCE)
    return parts if demand_type is None else parts.filter(F.col("metadata")["demand_type"] == demand_type)


def list_parts(chunks: DataFrame, demand_type: str | None = None) -> DataFrame:
    meta = F.col("metadata")
    fields = ("part_number", "demand_type", "region", "trend", "stockout_risk")
    return part_chunks_only(chunks, demand_type).select(*[meta[f].alias(f) for f in fields])


def risk_bucket(risk: Column) -> Column:
    """HIGH and MODERATE as they are, anything else is LOW."""
    return F.when(risk.isin("HIGH", "MODERATE"), risk).otherwise(F.lit("LOW"))


def risk_listing(chunks: DataFrame) -> DataFrame:
    """The parts with their bucket: a row each, never a list per bucket."""
    return list_parts(chunks).withColumn("bucket", risk_bucket(F.col("stockout_risk")))


def risk_buckets(chunks: DataFrame) -> DataFrame:
    return risk_listing(chunks).groupBy("bucket").agg(F.count(F.lit(1)).alias("n_parts"))


def kpi_cards(chunks: DataFrame, metrics: DataFrame) -> DataFrame:
    """Number of parts; the best model by MAE with its MAE and MAPE."""
    parts = part_chunks_only(chunks).agg(F.count(F.lit(1))).scalar()
    best = metrics.agg(F.min(F.struct("mae", "model", "mape")).alias("b"))
    return best.select(
        parts.alias("total_parts"),
        F.col("b.model").alias("best_model"),
        F.col("b.mae").alias("best_mae"),
        F.col("b.mape").alias("best_mape"),
    )


def demand_by_type(features: DataFrame) -> DataFrame:
    """Mean, sample deviation and total of demand per type."""
    q = F.col("demand_quantity").cast("long")
    n = F.count(F.lit(1))
    return features.groupBy("demand_type").agg(
        round_even(F.sum(q) / n, 2).alias("avg_daily_demand"),
        round_even(sample_std(n, whole_sum(q), square_sum(q)), 2).alias("std_deviation"),
        F.sum(q).alias("total_demand"),
    )


def distinct_types(chunks: DataFrame) -> DataFrame:
    """Sorted demand types of the parts, for a picker."""
    return list_parts(chunks).select("demand_type").distinct().orderBy("demand_type")
