"""Sample data: demand, prices and calendar.

Random draws are hashes of the row's own key, so a row is the same however the
rows are partitioned and however often a task is run again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow import fixed_values as fv


def uniform(*keys: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the keys and the seed only.

    The first 48 bits of a digest, so any other engine can draw the same.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def poisson_steps(mean: float) -> list[float]:
    """The cumulative distribution, up to where it is 1 for a double."""
    steps, total, term, i = [], 0.0, math.exp(-mean), 0
    while total < 1 - 1e-12 and i < 20 * mean + 50:
        total += term
        steps.append(min(total, 1.0))
        i += 1
        term *= mean / i
    return steps


def poisson(u: Column, mean: float) -> Column:
    """Poisson draw from a uniform one: how many steps lie at or below it."""
    return F.size(F.filter(F.array(*[F.lit(s) for s in poisson_steps(mean)]), lambda s: s <= u))


def department(item: Column) -> Column:
    """``HOBBIES_1_001`` belongs to ``HOBBIES_1``."""
    return F.regexp_extract(item, r"^(.*)_[^_]*$", 1)


def daily_demand(grid: DataFrame, seed: int = 42) -> DataFrame:
    """Fill ``item_id, dept_id, store_id, date`` rows with sales and events."""
    keys = [F.col(c) for c in ("item_id", "store_id", "date")]
    # Drawn once per row, ahead of the lambdas that look at it again and again.
    drawn = grid.withColumns({"_u": uniform(*keys, seed=seed), "_v": uniform(*keys, seed=seed + 1)})
    base = poisson(F.col("_u"), fv.SAMPLE_MEAN_OTHER)
    for prefix, mean in reversed(fv.SAMPLE_MEANS):
        base = F.when(F.col("dept_id").startswith(prefix), poisson(F.col("_u"), mean)).otherwise(base)
    weekend = F.weekday("date") >= 5
    based = drawn.withColumn("_base", base)
    sales = F.when(weekend, F.floor(F.col("_base") * fv.SAMPLE_WEEKEND_LIFT)).otherwise(F.col("_base")).cast("int")
    events = F.array(*[F.lit(e).cast("string") for e in fv.SAMPLE_EVENTS])
    pick = F.floor(F.col("_v") * len(fv.SAMPLE_EVENTS)).cast("int")
    return based.withColumns({"sales": sales, "event_name_1": F.get(events, pick)}).drop("_u", "_v", "_base")


def _grid(spark: SparkSession, items, stores, n: int) -> DataFrame:
    """Every item in every store n times, by arithmetic on one range."""
    total = len(items) * len(stores) * n
    i = F.col("id")
    return spark.range(total).select(
        F.get(F.array(*[F.lit(x) for x in items]), F.floor(i / (len(stores) * n)).cast("int")).alias("item_id"),
        F.get(F.array(*[F.lit(x) for x in stores]), (F.floor(i / n) % len(stores)).cast("int")).alias("store_id"),
        (i % n).cast("int").alias("k"),
    )


def sample_sales(spark: SparkSession, items=fv.SAMPLE_ITEMS, stores=fv.SAMPLE_STORES, days=fv.SAMPLE_DAYS, seed=42) -> DataFrame:
    grid = _grid(spark, items, stores, days).withColumns(
        {
            "dept_id": department(F.col("item_id")),
            "date": F.date_add(F.lit(fv.SAMPLE_START).cast("date"), F.col("k")),
        }
    )
    filled = daily_demand(grid, seed)
    return filled.select(
        "item_id",
        "dept_id",
        department(F.col("dept_id")).alias("cat_id"),
        "store_id",
        F.split("store_id", "_")[0].alias("state_id"),
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        "sales",
        "event_name_1",
    )


def sample_prices(spark: SparkSession, items=fv.SAMPLE_ITEMS, stores=fv.SAMPLE_STORES, weeks=fv.SAMPLE_PRICE_WEEKS, seed=42) -> DataFrame:
    base = 2.0 + 48.0 * uniform(F.col("item_id"), F.col("store_id"), seed=seed + 2)
    drift = 0.95 + 0.10 * uniform(F.col("item_id"), F.col("store_id"), F.col("k"), seed=seed + 3)
    return _grid(spark, items, stores, weeks).select(
        "store_id",
        "item_id",
        (F.col("k") + fv.FIRST_WEEK).alias("wm_yr_wk"),
        (F.rint(base * drift * 100) / 100).alias("sell_price"),
    )


def calendar_days(days: DataFrame, first: Column) -> DataFrame:
    """Calendar columns for rows of ``date``; ``first`` is the first date."""
    day = F.date_diff(F.col("date"), first)
    snaps = [((day % 7) < n).cast("int").alias(name) for name, n in fv.SNAP_DAYS.items()]
    return days.select(
        "date",
        (F.floor(day / 7) + fv.FIRST_WEEK).cast("int").alias("wm_yr_wk"),
        F.date_format("date", "EEEE").alias("weekday"),
        (F.weekday("date") + 1).alias("wday"),
        F.month("date").alias("month"),
        F.year("date").alias("year"),
        *snaps,
    )


def sample_calendar(spark: SparkSession, days=fv.SAMPLE_DAYS, seed=42) -> DataFrame:
    first = F.lit(fv.SAMPLE_START).cast("date")
    dates = spark.range(days).select(F.date_add(first, F.col("id").cast("int")).alias("date"))
    events = F.array(*[F.lit(e).cast("string") for e in fv.SAMPLE_EVENTS])
    event = F.get(events, F.floor(uniform(F.col("date"), seed=seed + 4) * len(fv.SAMPLE_EVENTS)).cast("int"))
    base = calendar_days(dates, first).withColumn("event_name_1", event)
    kind = F.when(F.col("event_name_1").isNotNull(), F.lit(fv.EVENT_KIND))
    return base.withColumn("event_type_1", kind).select(
        "date", "wm_yr_wk", "weekday", "wday", "month", "year", "event_name_1", "event_type_1", *fv.SNAP_DAYS
    )


def write_sample(spark: SparkSession, folder: str, seed: int = 42) -> None:
    """The three raw CSV tables, ready for ``load_raw``."""
    frames = (sample_sales(spark, seed=seed), sample_prices(spark, seed=seed), sample_calendar(spark, seed=seed))
    names = ("sales_train_evaluation.csv", "sell_prices.csv", "calendar.csv")
    for frame, name in zip(frames, names):
        frame.write.mode("overwrite").option("header", True).csv(f"{folder.rstrip('/')}/{name}")
