"""Helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``session.materialize`` that nothing reads any more."""
    for table_ in tables:
        files = table_.inputFiles()
        if files:
            spark = table_.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: What a worker has kept from an earlier task.
_kept: dict[Hashable, Any] = {}


def kept_by_worker(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, kept by the worker from task to task.

    A worker keeps one such thing at a time: another one takes its place, so
    what the stages of a run leave in a worker does not add up.
    """
    if key not in _kept:
        drop_kept()
        _kept[key] = make()
        _give_back()
    return _kept[key]


def drop_kept() -> None:
    """What the worker kept for an earlier operator goes: for tasks that need the room and not the thing."""
    if _kept:
        _kept.clear()
        _give_back()


def _give_back() -> None:
    """Freed memory goes back to the system, where the C library can do that."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def with_fields(schema: T.StructType, ddl: str) -> T.StructType:
    """``schema`` and the fields of ``ddl`` behind it."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of whole rows of about ``most`` bytes of ``column``."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        size = np.asarray(pa.compute.binary_length(texts).fill_null(0), dtype=np.int64) + 8
        part = (np.cumsum(size) - size) // most
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        for lo, hi in zip(cuts, [*cuts[1:], batch.num_rows]):
            yield batch.slice(int(lo), int(hi - lo))
