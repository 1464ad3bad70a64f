"""A saved boosted model as a table of nodes, read, walked and summed with joins.

The table does not grow with the data: a tree of depth d has less than
2 ** (d + 1) nodes, so it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partflow.operators.models.boosted import BoostedForecaster


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """One row per node of the model saved at ``path``.

    (tree, rate, node, feature, threshold, below, above, prediction, gain, n): a row
    goes ``below`` if its feature is at most the threshold, a leaf has no feature;
    ``gain`` is what the split takes off the variance, ``n`` the rows trained on.
    """
    names = F.array(*[F.lit(c) for c in BoostedForecaster().load(path).columns()])
    rates = spark.read.parquet(f"{path}/stages/1_*/treesMetadata").toDF("tree", "about", "rate")
    nodes = spark.read.parquet(f"{path}/stages/1_*/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner = F.col("leftChild") >= 0

    def split(column):
        return F.when(inner, column)

    table = nodes.select(
        "tree",
        F.col("id").alias("node"),
        split(F.get(names, F.col("split.featureIndex"))).alias("feature"),
        split(F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        split(F.col("leftChild")).alias("below"),
        split(F.col("rightChild")).alias("above"),
        "prediction",
        split(F.col("gain")).alias("gain"),
        F.get("impurityStats", F.lit(0)).alias("n"),
    )
    return table.join(F.broadcast(rates.select("tree", "rate")), "tree")


def walk(rows: DataFrame, nodes: DataFrame, depth: int, key: tuple[str, ...]) -> DataFrame:
    """(key, predicted) of every row: one join a level takes it down all trees at once.

    ``key`` tells rows apart. A null feature goes above, as no comparison holds.
    """
    features = [c for c in BoostedForecaster().features if c in rows.columns]
    values = F.create_map(*[x for c in features for x in (F.lit(c), F.col(c).cast("double"))])
    # As many as the model was told to have.
    roots = nodes.filter("node = 0").agg(F.collect_list("tree")).scalar()
    at = rows.select(*key, values.alias("values"), F.explode(roots).alias("tree"), F.lit(0).alias("node"))
    for _ in range(depth):
        step = at.join(F.broadcast(nodes), ["tree", "node"])
        child = F.when(F.col("values")[F.col("feature")] <= F.col("threshold"), F.col("below")).otherwise(F.col("above"))
        at = step.select(*key, "values", "tree", F.when(F.col("feature").isNull(), F.col("node")).otherwise(child).alias("node"))
    ends = at.join(F.broadcast(nodes), ["tree", "node"])
    total = F.sum(F.col("rate") * F.col("prediction"))
    return ends.groupBy(*key).agg(F.greatest(total, F.lit(0.0)).alias("predicted"))


def gain_shares(nodes: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """(feature, importance): the share of a feature's splits in what all splits take off the squares.

    Features without a split have 0. Without any split all have 0.
    """
    names = nodes.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    taken = nodes.filter("feature is not null").groupBy("feature").agg(F.sum(F.col("gain") * F.col("n")).alias("gain"))
    found = names.join(F.broadcast(taken), "feature", "left")
    # A row per feature.
    total = F.sum("gain").over(Window.partitionBy(F.lit(0)))
    return found.select("feature", F.coalesce(F.col("gain") / F.nullif(total, F.lit(0.0)), F.lit(0.0)).alias("importance"))
