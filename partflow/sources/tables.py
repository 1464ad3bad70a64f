"""Reading the raw tables and writing the results."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.functions.text import json_object, json_text

# Column types of the raw tables; a column that is not listed is text.
SALES_TYPES = {
    "item_id": T.StringType(),
    "dept_id": T.StringType(),
    "cat_id": T.StringType(),
    "store_id": T.StringType(),
    "state_id": T.StringType(),
    "date": T.StringType(),
    "sales": T.DoubleType(),
    "event_name_1": T.StringType(),
    "wm_yr_wk": T.IntegerType(),
    "sell_price": T.DoubleType(),
}
PRICES_TYPES = {
    "store_id": T.StringType(),
    "item_id": T.StringType(),
    "wm_yr_wk": T.IntegerType(),
    "sell_price": T.DoubleType(),
}
CALENDAR_TYPES = {
    "date": T.DateType(),
    "wm_yr_wk": T.IntegerType(),
    "weekday": T.StringType(),
    "wday": T.IntegerType(),
    "month": T.IntegerType(),
    "year": T.IntegerType(),
    "event_name_1": T.StringType(),
    "event_type_1": T.StringType(),
    "snap_CA": T.IntegerType(),
    "snap_TX": T.IntegerType(),
    "snap_WI": T.IntegerType(),
}
RAW_FILES = {
    "sales": ("sales_train_evaluation.csv", SALES_TYPES),
    "prices": ("sell_prices.csv", PRICES_TYPES),
    "calendar": ("calendar.csv", CALENDAR_TYPES),
}


def read_csv(spark: SparkSession, path: str, types: dict[str, T.DataType]) -> DataFrame:
    """A headed CSV file with declared types and no inference pass.

    The header line says which columns there are and in which order.
    """
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    """Sales, with fractions of a unit cut off."""
    return read_csv(spark, path, SALES_TYPES).withColumn("sales", F.col("sales").try_cast("int"))


def load_raw(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sales, prices and calendar; a missing file is named in the error."""
    frames = []
    for name, (file, types) in RAW_FILES.items():
        path = f"{folder.rstrip('/')}/{file}"
        try:
            frames.append(read_sales(spark, path) if name == "sales" else read_csv(spark, path, types))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                raise FileNotFoundError(f"Missing {name} file: {path}") from e
            raise
    return tuple(frames)


def write_table(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Parquet, optionally in one folder per value of a small vocabulary."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Chunks as JSON lines, each with its id, text and metadata object."""
    pairs = [("id", json_text(F.col("id"))), ("text", json_text(F.col("text"))), ("metadata", F.col("metadata_json"))]
    chunks.select(json_object(pairs).alias("value")).write.mode("overwrite").text(path)


CHUNK_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)


def read_chunks(spark: SparkSession, path: str, array_file: bool = False) -> DataFrame:
    """Stored chunks; ``array_file`` reads one JSON array instead of lines."""
    raw = spark.read.schema(CHUNK_SCHEMA).option("multiLine", array_file).json(path)
    return raw.withColumn("source", F.col("metadata")["source"])
