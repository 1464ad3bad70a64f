"""Boosted regression trees over the feature table."""

from __future__ import annotations

import json
import math

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow import fixed_values as fv
from partflow.operators.models.histograms import MAX_BINS, grow, node_rows
from partflow.session import ensure_checkpoint_dir, scratch_path

# Training rows that one task holds, on average.
ROWS_PER_TASK = 500_000


def spread(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` in as many partitions as keep them within ``limit`` rows each.

    Packed files come in few partitions, which grow with the table; a pass of
    the training reads a whole one at a time.
    """
    needed = math.ceil(rows.count() / limit)
    return rows.repartition(needed) if needed > rows.rdd.getNumPartitions() else rows


NODE = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
    "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def as_model(spark: SparkSession, pipeline: Pipeline, nodes: list[tuple], features: int) -> PipelineModel:
    """The Spark model of ``pipeline`` that has these nodes, by way of its saved form."""
    path = scratch_path(spark, "trees")
    pipeline.write().save(path)
    booster = pipeline.getStages()[1]
    stage = f"{path}/stages/1_{booster.uid}"
    trees = nodes[-1][0] + 1

    def rewrite(folder: str, **changes) -> dict:
        about = json.loads(spark.read.text(f"{folder}/metadata").first()[0]) | changes
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/metadata")
        return about

    rewrite(path, **{"class": "org.apache.spark.ml.PipelineModel"})
    about = rewrite(stage, **{"class": "org.apache.spark.ml.regression.GBTRegressionModel", "numFeatures": features, "numTrees": trees})
    one = {k: about[k] for k in ("timestamp", "sparkVersion")} | {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "paramMap": {}, "defaultParamMap": {}}
    each = [(t, json.dumps(one | {"uid": f"{booster.uid}_{t}"}), booster.getStepSize() if t else 1.0) for t in range(trees)]
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{stage}/treesMetadata")
    spark.createDataFrame(nodes, NODE).coalesce(1).write.parquet(f"{stage}/data")
    return PipelineModel.load(path)


class BoostedForecaster:
    """Train, predict (clipped at 0), rank features, save and load."""

    def __init__(
        self,
        trees: int = fv.BOOSTED["trees"],
        depth: int = fv.BOOSTED["depth"],
        rate: float = fv.BOOSTED["rate"],
        row_share: float = fv.BOOSTED["row_share"],
        seed: int = fv.BOOSTED["seed"],
        features: tuple[str, ...] = fv.FEATURE_COLUMNS,
    ):
        self.params = {"trees": trees, "depth": depth, "rate": rate, "row_share": row_share, "seed": seed}
        self.features = features
        self.model: PipelineModel | None = None

    def train(self, rows: DataFrame) -> "BoostedForecaster":
        spark, p = rows.sparkSession, self.params
        ensure_checkpoint_dir(spark)
        columns = [c for c in self.features if c in rows.columns]
        label = F.col(fv.TARGET_COLUMN).cast("double").alias("_label")
        labelled = spread(rows.select(*[F.col(c).cast("double").alias(c) for c in columns], label), ROWS_PER_TASK)
        layout, grown = grow(labelled, rows.count(), columns, "_label", p["trees"], p["depth"], p["rate"], p["row_share"], p["seed"])
        nodes = [row for t, tree in enumerate(grown) for row in node_rows(t, tree, layout)]
        self.model = as_model(spark, self.pipeline(columns), nodes, len(columns))
        return self

    def pipeline(self, columns: list[str]) -> Pipeline:
        """The stages whose model the trees are."""
        assembler = VectorAssembler(inputCols=columns, outputCol="_features")
        booster = GBTRegressor(
            featuresCol="_features",
            labelCol="_label",
            predictionCol="predicted",
            maxIter=self.params["trees"],
            maxDepth=self.params["depth"],
            stepSize=self.params["rate"],
            subsamplingRate=self.params["row_share"],
            seed=self.params["seed"],
            featureSubsetStrategy="all",
            lossType="squared",
            maxBins=MAX_BINS,
        )
        return Pipeline(stages=[assembler, booster])

    def _trained(self) -> PipelineModel:
        if self.model is None:
            raise ValueError("the model is not trained: call train() or load() first")
        return self.model

    def columns(self) -> list[str]:
        """The features of the trained model, in its order."""
        return self._trained().stages[0].getInputCols()

    def predict(self, rows: DataFrame) -> DataFrame:
        """Append ``predicted``."""
        scored = self._trained().transform(rows).drop("_features")
        return scored.withColumn("predicted", F.greatest(F.col("predicted"), F.lit(0.0)))

    def importances(self, spark: SparkSession) -> DataFrame:
        """One row per feature; the shares sum to 1. Bounded by the features."""
        assembler, booster = self._trained().stages
        shares = booster.featureImportances.toArray()
        pairs = [(name, float(share)) for name, share in zip(assembler.getInputCols(), shares)]
        return spark.createDataFrame(pairs, "feature string, importance double")

    def top_importances(self, spark: SparkSession, n: int = 10) -> DataFrame:
        return self.importances(spark).orderBy(F.desc("importance"), "feature").limit(n)

    def save(self, path: str) -> None:
        self._trained().write().overwrite().save(path)

    def load(self, path: str) -> "BoostedForecaster":
        self.model = PipelineModel.load(path)
        return self
