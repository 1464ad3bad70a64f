"""Exact row order at any scale.

A window over a key sorts all rows of that key in one task. That is the best
plan as long as no key is huge. For keys that are, and for orders over the
whole table, the rows are range-partitioned by their complete sort key, which
splits a hot key over as many partitions as it needs. Positions follow from the
partition sizes, and windows then run over fixed-size chunks of positions that
are handed the few preceding rows they look back at.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partflow.session import materialize

# Rows of one key that a single task may sort.
ROWS_PER_TASK = 2_000_000


# Default of the ``hot`` arguments: find the hot keys of the input first.
DETECT = "detect"


def range_partitions(df: DataFrame, rows: int | None = None) -> int:
    """The session's shuffle partitions, or more if ``rows`` would overfill them."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return usual if rows is None else max(usual, math.ceil(rows / ROWS_PER_TASK))


def hot_keys(rows: DataFrame, key: list[str], limit: int = ROWS_PER_TASK) -> DataFrame | None:
    """Keys with more than ``limit`` rows, or ``None`` if there are none.

    ``rows`` only needs the key columns. When the table as a whole is within
    the limit, no key can be beyond it and the count (for a Parquet scan, a
    read of footers) settles it. At most rows/limit keys are hot.
    """
    if rows.count() <= limit:
        return None
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit)
    hot = materialize(counts, "hot-keys")
    return None if hot.isEmpty() else hot


def resolve_hot(df: DataFrame, key: list[str], hot: DataFrame | str | None, limit: int) -> DataFrame | None:
    """``hot`` itself, or the hot keys of ``df`` where it is DETECT."""
    if isinstance(hot, str):
        return hot_keys(df.select(*key), key, limit)
    return hot


def with_positions(
    df: DataFrame, group: list[str], order: list[str], column: str = "_pos", rows: int | None = None
) -> DataFrame:
    """Append the 0-based position of each row within its group.

    ``group + order`` must identify a row. Costs one range shuffle and one
    write; meant for few groups of any size (``group`` may be empty). ``rows``,
    if known, sizes the partitions. The sorted rows are written before they are counted because the sampled range
    bounds belong to that one shuffle.
    """
    keys = [*group, *order]
    ranged = df.repartitionByRange(range_partitions(df, rows), *keys).sortWithinPartitions(*keys)
    ranged = ranged.withColumns({"_range": F.spark_partition_id(), "_seq": F.monotonically_increasing_id()})
    ranged = materialize(ranged, "ordered")
    pieces = ranged.groupBy(*group, "_range").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # One row per (group, range): as many as ranges plus groups.
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        *group, "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    placed = ranged.join(offsets, [*group, "_range"])
    return placed.withColumn(column, F.col("_seq") + F.col("_shift")).drop("_range", "_seq", "_shift")


def with_halo(df: DataFrame, back: int, chunk_rows: int = ROWS_PER_TASK, position: str = "_pos") -> DataFrame:
    """Cut positions into chunks; each also gets the ``back`` rows before it.

    Adds ``_chunk`` and ``_halo`` (1 on the borrowed copies, which are only
    there to be looked back at). ``chunk_rows`` must be at least ``back``.
    """
    chunk = F.floor(F.col(position) / chunk_rows).cast("long")
    own = F.struct(chunk.alias("_chunk"), F.lit(0).alias("_halo"))
    lent = F.struct((chunk + 1).alias("_chunk"), F.lit(1).alias("_halo"))
    near_end = F.col(position) % chunk_rows >= chunk_rows - back
    copies = F.when(near_end, F.array(own, lent)).otherwise(F.array(own))
    return df.withColumn("_c", F.explode(copies)).select("*", "_c._chunk", "_c._halo").drop("_c")


def windowed(
    df: DataFrame,
    group: list[str],
    order: list[str],
    build,
    back: int,
    hot: DataFrame | str | None = DETECT,
    chunk_rows: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add window columns that look back at most ``back`` rows.

    ``build(spec)`` returns ``{name: column}`` for a window spec. Groups in
    ``hot`` take the chunked way, all others one sort per group; the values
    are the same. ``hot=None`` states that there are none.
    """
    hot = resolve_hot(df, group, hot, chunk_rows)
    if hot is None:
        return df.withColumns(build(Window.partitionBy(*group).orderBy(*order)))
    columns = df.columns
    cold = df.join(hot, group, "left_anti")
    plain = cold.withColumns(build(Window.partitionBy(*group).orderBy(*order)))
    rows = hot.agg(F.sum("_rows")).first()[0]
    placed = with_positions(df.join(hot, group, "left_semi"), group, order, rows=rows)
    chunked = with_halo(placed, back, max(chunk_rows, back))
    spec = Window.partitionBy(*group, "_chunk").orderBy("_pos")
    split = chunked.withColumns(build(spec)).filter(F.col("_halo") == 0)
    return plain.unionByName(split.select(*columns, *[c for c in plain.columns if c not in columns]))


def windowed_whole(
    df: DataFrame, order: list[str], build, back: int, chunk_rows: int = ROWS_PER_TASK, rows: int | None = None
) -> DataFrame:
    """``windowed`` over the whole table as one group, never in one task."""
    columns = df.columns
    chunked = with_halo(with_positions(df, [], order, rows=rows), back, max(chunk_rows, back))
    built = chunked.withColumns(build(Window.partitionBy("_chunk").orderBy("_pos"))).filter(F.col("_halo") == 0)
    return built.select(*columns, *[c for c in built.columns if c not in columns and not c.startswith("_")])


def number_rows(df: DataFrame, order: list[str], column: str = "row", rows: int | None = None) -> DataFrame:
    """0-based row numbers over the whole table in the given order."""
    return with_positions(df, [], order, column, rows)
