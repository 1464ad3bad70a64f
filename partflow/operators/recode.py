"""Recoding the raw retail tables to the demand schema, and price attachment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow import fixed_values as fv
from partflow.functions.numbers import exact_mean
from partflow.session import materialize

# A dictionary up to this size becomes a literal map inside the projection; a
# larger one is joined. Up to BROADCAST_ENTRIES it is sent to every executor.
LITERAL_ENTRIES = 64
BROADCAST_ENTRIES = 200_000


def recode(df: DataFrame, source: str, target: str, mapping: dict[str, str], miss: Column | None = None) -> DataFrame:
    """Set ``target`` to the dictionary value of ``source``.

    ``miss`` is the value for keys that are not in the dictionary: a literal
    (constant default), the source column (keep) or ``None`` (null).
    """
    fallback = F.lit(None).cast("string") if miss is None else miss
    if not mapping:
        return df.withColumn(target, fallback)
    if len(mapping) <= LITERAL_ENTRIES:
        lookup = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
        return df.withColumn(target, F.coalesce(lookup[F.col(source)], fallback))
    table = df.sparkSession.createDataFrame(list(mapping.items()), "_key string, _value string")
    if len(mapping) <= BROADCAST_ENTRIES:
        table = F.broadcast(table)
    joined = df.join(table, F.col(source) == F.col("_key"), "left")
    return joined.withColumn(target, F.coalesce(F.col("_value"), fallback)).drop("_key", "_value")


def average_prices(prices: DataFrame) -> DataFrame:
    """Mean price of an item in a store over all weeks."""
    return prices.groupBy("item_id", "store_id").agg(exact_mean(F.col("sell_price")).alias("sell_price"))


def attach_prices(sales: DataFrame, prices: DataFrame, item_map: dict[str, str]) -> DataFrame:
    """Left join of the average prices; a miss costs the small default.

    Item names in ``sales`` are recoded already, so the averages are recoded
    after grouping. Sales that carry their own week key are not priced.
    """
    if "sell_price" in prices.columns and "wm_yr_wk" not in sales.columns:
        averages = average_prices(prices)
        averages = recode(averages, "item_id", "item_id", item_map, F.col("item_id"))
        sales = sales.join(averages, ["item_id", "store_id"], "left")
        return sales.withColumn("sell_price", F.coalesce("sell_price", F.lit(fv.DEFAULT_UNIT_COST)))
    if "sell_price" not in sales.columns:
        return sales.withColumn("sell_price", F.lit(fv.DEFAULT_UNIT_COST))
    return sales


def attach_weekly_prices(sales: DataFrame, prices: DataFrame) -> DataFrame:
    """Variant for sales with a week key: the price of that very week.

    The weekly prices become a table, so that the join has exchanges of its own
    on both sides and a hot (item, store, week) can be split.
    """
    keys = ["item_id", "store_id", "wm_yr_wk"]
    weekly = prices.groupBy(*keys).agg(exact_mean(F.col("sell_price")).alias("sell_price"))
    joined = sales.join(materialize(weekly, "weekly-prices"), keys, "left")
    return joined.withColumn("sell_price", F.coalesce("sell_price", F.lit(fv.DEFAULT_UNIT_COST)))


def rename_and_project(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Demand column names in their fixed order; absent columns are skipped.

    ``keep`` names key columns to carry along behind them.
    """
    renamed = df.withColumnsRenamed(fv.RAW_TO_DEMAND)
    wanted = [c for c in fv.DEMAND_COLUMNS if c in renamed.columns]
    return renamed.select(*wanted, *[c for c in keep if c in renamed.columns and c not in wanted])


def conform(
    sales: DataFrame,
    prices: DataFrame,
    keep: tuple[str, ...] = (),
    dept_map: dict[str, str] = fv.DEPT_TO_DEMAND_TYPE,
    store_map: dict[str, str] = fv.STORE_TO_REGION,
    item_map: dict[str, str] = fv.ITEM_TO_PART_NUMBER,
    category_map: dict[str, str] = fv.CATEGORY_TO_DESCRIPTION,
    event_map: dict[str, str] = fv.EVENT_TO_SIGNAL,
) -> DataFrame:
    """Raw sales and prices to demand records."""
    df = recode(sales, "item_id", "item_id", item_map, F.col("item_id"))
    # Prices first: the short raw values go through that join, the long texts need not.
    df = attach_prices(df, prices, item_map)
    df = recode(df, "dept_id", "demand_type", dept_map, F.lit(fv.DEFAULT_DEMAND_TYPE))
    df = recode(df, "store_id", "region", store_map, F.lit(fv.DEFAULT_REGION))
    df = recode(df, "cat_id", "cat_id", category_map, F.col("cat_id"))
    if "event_name_1" in df.columns:
        df = recode(df, "event_name_1", "event_name_1", event_map)
    return rename_and_project(df, keep)
