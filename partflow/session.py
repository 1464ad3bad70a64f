"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dirs: dict[str, str] = {}


def get_spark(name: str = "partflow", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the plans count on.

    Adaptive execution sizes the shuffles and splits skewed joins; UTC keeps
    dates apart from the machine's zone. On a cluster leave ``master`` unset.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``.

    Only where that is unset in a local session (tests, a laptop) a fresh local
    folder stands in; on a cluster executors would not share it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    return _own_dirs[app]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``checkpoint()`` at the shared folder unless it already has one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the application's part of the shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/partflow/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove all tables that this application left in the shared folder.

    For the end of a run: frames that still read such a table fail afterwards.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries within go as soon as the query has ended."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts the lineage, outlives any executor, and gives the planner real
    sizes for whatever joins the result next. The shuffles behind it are not
    needed any more and leave the disks. ``partition`` is a column of few values
    that gets a folder for each.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with dropping_shuffles(spark):
        (df.write.partitionBy(partition) if partition else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def growing(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never sent whole.

    The planner judges a table by its packed files and would broadcast one that
    takes many times as much as rows on the driver.
    """
    return df.hint("merge")


def broadcast_within(df: DataFrame, rows: DataFrame, limit: int = 1_000_000) -> DataFrame:
    """``df`` with a broadcast hint if ``rows``, which bounds it, is small.

    ``rows`` should be a plain scan, whose count reads file footers only.
    Beyond the limit the join is left to the planner and shuffles.
    """
    return F.broadcast(df) if rows.count() <= limit else df
