"""Seasonal exponential smoothing with one state per part.

The recursion is sequential within a part and independent across parts. A part
of ordinary length is folded from its ordered values in one row, JVM-side, by a
higher-order aggregate. A part with more rows than one task should hold is
folded chunk after chunk: each round folds one chunk of every long part and
hands its state on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow import fixed_values as fv
from partflow.operators.ordering import DETECT, ROWS_PER_TASK, resolve_hot, with_positions
from partflow.session import materialize, scratch_path

PART, DATE, QUANTITY = "part_number", "transaction_date", "demand_quantity"
STATE = "struct<level:double,trend:double,seasonal:array<double>>"


# Rows of a part that are folded in one row; longer parts go chunk after chunk.
FOLD_ROWS = 100_000


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)


def _start(x: Column, period: int) -> Column:
    """State after the first season."""
    first = F.slice(x, 1, period)
    level = _mean(first)
    second = F.slice(x, period + 1, period)
    trend = F.when(F.size(x) >= 2 * period, (_mean(second) - level) / period).otherwise(F.lit(0.0))
    seasonal = F.transform(first, lambda v: F.when(level > 0, v / level).otherwise(F.lit(1.0)))
    return F.struct(level.alias("level"), trend.alias("trend"), seasonal.alias("seasonal")).cast(STATE)


def _step(state: Column, x: Column, alpha: float, beta: float, period: int) -> Column:
    """State after one more value.

    The factor of the value's season is the first of ``seasonal``; its new
    value goes to the end, so the list turns by one with every value.
    """
    old = F.get(state["seasonal"], F.lit(0))
    ahead = state["level"] + state["trend"]
    level = alpha * (x / F.greatest(old, F.lit(fv.SEASONAL_FLOOR))) + (1 - alpha) * ahead
    trend = beta * (level - state["level"]) + (1 - beta) * state["trend"]
    fresh = F.when(level > 0, alpha * (x / level) + (1 - alpha) * old).otherwise(old)
    seasonal = F.concat(F.slice(state["seasonal"], 2, period - 1), F.array(fresh))
    return F.struct(level.alias("level"), trend.alias("trend"), seasonal.alias("seasonal"))


def _fold(start: Column, values: Column, alpha: float, beta: float, period: int) -> Column:
    return F.aggregate(values, start, lambda s, x: _step(s, x, alpha, beta, period))


def _ordered_values(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Per group the quantities in order, as doubles."""
    entry = F.struct(*order, F.col(QUANTITY).cast("double").alias("_x"))
    lists = df.groupBy(*group).agg(F.sort_array(F.collect_list(entry)).alias("_rows"))
    return lists.select(*group, F.transform("_rows", lambda r: r["_x"]).alias("x"))


def _turned(seasonal: Column, by: Column, period: int) -> Column:
    """The list turned so that its first entry comes to index ``by``."""
    index = F.sequence(F.lit(0), F.lit(period - 1))
    return F.transform(index, lambda j: F.get(seasonal, F.pmod(j - by, F.lit(period)).cast("int")))


def _finished(df: DataFrame, period: int, phase: str) -> DataFrame:
    """Public state columns out of ``n``, ``mean``, ``state``, ``last_values``.

    After n values the list starts at season ``n % period``. With the weekday
    phase position 0 is the weekday of ``_d0`` instead of 0.
    """
    short = F.col("n") < period + 2
    turn = F.col("n") % period
    if phase == "weekday":
        turn = turn + F.weekday("_d0")
    return df.select(
        PART,
        F.when(short, F.lit("mean")).otherwise(F.lit("holt_winters")).alias("type"),
        "n",
        F.when(short, F.col("mean")).alias("mean"),
        F.when(~short, F.col("state.level")).alias("level"),
        F.when(~short, F.col("state.trend")).alias("trend"),
        F.when(~short, _turned(F.col("state.seasonal"), turn, period)).alias("seasonal"),
        "last_values",
    )


def fit_seasonal(
    train: DataFrame,
    ties: tuple[str, ...] = (),
    alpha: float = fv.SMOOTHING["alpha"],
    beta: float = fv.SMOOTHING["beta"],
    period: int = fv.SMOOTHING["period"],
    phase: str = "position",
    hot: DataFrame | str | None = DETECT,
    chunk_rows: int = FOLD_ROWS,
) -> DataFrame:
    """One state row per part of the training rows.

    Parts shorter than ``period + 2`` get a plain mean. With
    ``phase="weekday"`` the seasonal index starts at the weekday of the first
    row instead of at the row position, so that fitting and predicting agree
    for daily rows.
    """
    hot = resolve_hot(train, [PART], hot, chunk_rows)
    if hot is None:
        return _fit_whole(train, ties, alpha, beta, period, phase)
    cold = _fit_whole(train.join(hot, PART, "left_anti"), ties, alpha, beta, period, phase)
    rows = hot.agg(F.sum("_rows")).first()[0]
    long = _fit_in_chunks(train.join(hot, PART, "left_semi"), ties, alpha, beta, period, phase, chunk_rows, rows)
    return cold.unionByName(long)


def _fit_whole(train, ties, alpha, beta, period, phase) -> DataFrame:
    series = _ordered_values(train.select(PART, DATE, *ties, QUANTITY), [PART], [DATE, *ties])
    if phase == "weekday":
        firsts = train.groupBy(PART).agg(F.min(DATE).alias("_d0"))
        series = series.join(firsts, PART)
    n = F.size("x")
    rest = F.slice(F.col("x"), F.lit(period + 1), F.greatest(n - period, F.lit(0)))
    state = F.when(n >= period + 2, _fold(_start(F.col("x"), period), rest, alpha, beta, period))
    fitted = series.select(
        PART,
        *([F.col("_d0")] if phase == "weekday" else []),
        n.alias("n"),
        _mean(F.col("x")).alias("mean"),
        state.alias("state"),
        F.slice(F.col("x"), F.greatest(n - period + 1, F.lit(1)), F.least(n, F.lit(period))).alias("last_values"),
    )
    return _finished(fitted, period, phase)


def _fit_in_chunks(train, ties, alpha, beta, period, phase, chunk_rows, n_rows) -> DataFrame:
    """Rounds over chunks of the long parts; memory per task stays bounded."""
    chunk_rows = max(chunk_rows, 2 * period)
    placed = with_positions(train.select(PART, DATE, *ties, QUANTITY), [PART], [DATE, *ties], rows=n_rows)
    placed = placed.withColumn("_chunk", F.floor(F.col("_pos") / chunk_rows).cast("long"))
    path = scratch_path(train.sparkSession, "long-series")
    # By chunk on disk, so that a round reads its own rows only.
    placed.write.partitionBy("_chunk").parquet(path)
    rows = train.sparkSession.read.schema(placed.schema).parquet(path)
    totals = rows.groupBy(PART).agg(
        F.count(F.lit(1)).cast("int").alias("n"),
        F.avg(QUANTITY).alias("mean"),
        F.min(DATE).alias("_d0"),
    )
    last_chunk = rows.agg(F.max("_chunk")).first()[0]
    if last_chunk is None:  # the long parts have no training rows
        return _fit_whole(train, ties, alpha, beta, period, phase)
    rounds = last_chunk + 1
    state = None
    for i in range(rounds):
        values = _ordered_values(rows.filter(F.col("_chunk") == i), [PART], ["_pos"])
        tail = F.slice(F.col("x"), F.greatest(F.size("x") - period + 1, F.lit(1)), F.least(F.size("x"), F.lit(period)))
        if state is None:
            rest = F.slice(F.col("x"), F.lit(period + 1), F.greatest(F.size("x") - period, F.lit(0)))
            folded = values.select(
                PART,
                _fold(_start(F.col("x"), period), rest, alpha, beta, period).alias("state"),
                tail.alias("last_values"),
            )
        else:
            joined = state.join(values, PART, "left")
            both = F.concat("last_values", "x")
            folded = joined.select(
                PART,
                F.when(F.col("x").isNull(), F.col("state"))
                .otherwise(_fold(F.col("state"), F.col("x"), alpha, beta, period))
                .alias("state"),
                F.when(F.col("x").isNull(), F.col("last_values"))
                .otherwise(F.slice(both, F.size(both) - period + 1, F.lit(period)))
                .alias("last_values"),
            )
        state = materialize(folded, f"series-state-{i}")
    return _finished(state.join(totals, PART), period, phase)


def predict_seasonal(test: DataFrame, states: DataFrame) -> DataFrame:
    """Append ``predicted``: state lookup by part, 0 for an unknown part.

    The smoothed value is clipped at 0, a mean is not. Adaptive execution
    splits the join where one part dominates the test rows.
    """
    slim = states.select(
        PART,
        F.col("type").alias("_type"),
        F.col("mean").alias("_mean"),
        (F.col("level") + F.col("trend")).alias("_base"),
        F.col("seasonal").alias("_seasonal"),
    )
    factor = F.get("_seasonal", (F.weekday(DATE) % F.greatest(F.size("_seasonal"), F.lit(1))).cast("int"))
    smoothed = F.greatest(F.col("_base") * factor, F.lit(0.0))
    value = F.when(F.col("_type") == "mean", F.col("_mean")).otherwise(smoothed)
    joined = test.join(slim, PART, "left")
    return joined.withColumn("predicted", F.coalesce(value, F.lit(0.0))).drop("_type", "_mean", "_base", "_seasonal")
