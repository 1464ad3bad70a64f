import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from partflow import fixed_values as fv
from partflow.operators import evaluate as ev
from partflow.operators import features as ft
from partflow.operators import ordering
from partflow.operators.models import trees
from partflow.operators.models.boosted import BoostedForecaster
from partflow.operators.models.naive import predict_naive
from partflow.operators.models.seasonal import fit_seasonal, predict_seasonal
from partflow.session import scratch_path


def smooth(x, alpha=0.3, beta=0.1, period=7):
    level = float(np.mean(x[:period]))
    trend = (np.mean(x[period : 2 * period]) - level) / period if len(x) >= 2 * period else 0.0
    season = [v / level if level > 0 else 1.0 for v in x[:period]]
    for t in range(period, len(x)):
        i = t % period
        new = alpha * x[t] / max(season[i], 0.01) + (1 - alpha) * (level + trend)
        trend = beta * (new - level) + (1 - beta) * trend
        if new > 0:
            season[i] = alpha * x[t] / new + (1 - alpha) * season[i]
        level = new
    return level, trend, season


def check_states(states, series):
    rows = {r["part_number"]: r for r in states.collect()}
    pdf = series.toPandas().sort_values(["transaction_date", "tie"])
    for part, group in pdf.groupby("part_number"):
        x, r = [float(v) for v in group["demand_quantity"]], rows[part]
        assert r["n"] == len(x)
        assert r["last_values"] == x[-7:]
        if len(x) < 9:
            assert r["type"] == "mean" and r["mean"] == pytest.approx(np.mean(x)) and r["level"] is None
        else:
            level, trend, season = smooth(x)
            assert r["type"] == "holt_winters"
            assert (r["level"], r["trend"]) == pytest.approx((level, trend))
            assert r["seasonal"] == pytest.approx(season)


def test_fit_agrees_with_a_loop(series):
    check_states(fit_seasonal(series, ("tie",)), series)


@pytest.mark.parametrize("chunk_rows", [14, 17, 40])
def test_long_parts_fold_in_chunks(series, chunk_rows):
    hot = ordering.hot_keys(series.select("part_number"), ["part_number"], 20)
    check_states(fit_seasonal(series, ("tie",), hot=hot, chunk_rows=chunk_rows), series)


def test_all_zero_part(spark):
    day = datetime.date(2020, 1, 6)
    df = spark.createDataFrame([("z", day + datetime.timedelta(days=i), 0) for i in range(20)], "part_number string, transaction_date date, demand_quantity int")
    row = fit_seasonal(df).first()
    assert row["level"] == 0 and row["seasonal"] == [1.0] * 7


def test_weekday_phase(spark):
    monday = datetime.date(2020, 1, 6)
    rows = [("w", monday + datetime.timedelta(days=i + 2), 10 + (i + 2) % 7) for i in range(70)]
    df = spark.createDataFrame(rows, "part_number string, transaction_date date, demand_quantity int")
    plain, turned = fit_seasonal(df).first(), fit_seasonal(df, phase="weekday").first()
    assert turned["seasonal"][2:] + turned["seasonal"][:2] == plain["seasonal"]


def test_prediction(series, spark):
    states = fit_seasonal(series.filter("part_number <> 'B'"), ("tie",))
    rows = {(r["part_number"], r["tie"]): r for r in predict_seasonal(series, states).collect()}
    level, trend, season = smooth([float(r["demand_quantity"]) for r in series.filter("part_number = 'A'").orderBy("tie").collect()])
    day = rows["A", 9]["transaction_date"].weekday()
    assert rows["A", 9]["predicted"] == pytest.approx(max((level + trend) * season[day], 0))
    assert rows["B", 0]["predicted"] == 0.0
    assert rows["C", 0]["predicted"] == pytest.approx(np.mean([r["demand_quantity"] for k, r in rows.items() if k[0] == "C"]))


def test_boosted_trees(series, spark):
    rows = ft.build_features(series, ("tie",))
    model = BoostedForecaster(trees=3, depth=3)
    with pytest.raises(ValueError):
        model.predict(rows)
    model.train(rows)
    scored = model.predict(rows)
    assert scored.filter("predicted < 0").count() == 0
    shares = model.importances(spark).collect()
    assert {r["feature"] for r in shares} == set(fv.FEATURE_COLUMNS)
    assert sum(r["importance"] for r in shares) == pytest.approx(1)
    assert model.top_importances(spark).count() == 10
    path = scratch_path(spark, "model")
    model.save(path)
    again = BoostedForecaster().load(path).predict(rows)
    key = ["part_number", "tie"]
    assert [tuple(r) for r in scored.select(*key, "predicted").orderBy(*key).collect()] == [
        tuple(r) for r in again.select(*key, "predicted").orderBy(*key).collect()
    ]


def test_table_of_nodes(series, spark):
    rows = ft.build_features(series, ("tie",))
    model = BoostedForecaster(trees=6, depth=3, row_share=0.8).train(rows)
    path = scratch_path(spark, "model")
    model.save(path)
    nodes = trees.node_table(spark, path)
    assert {r["tree"]: r["rate"] for r in nodes.select("tree", "rate").distinct().collect()} == {0: 1.0, **{t: 0.1 for t in range(1, 6)}}
    key = ("part_number", "tie")
    walked = {r[:2]: r[2] for r in trees.walk(rows, nodes, 3, key).collect()}
    scored = {r[:2]: r[2] for r in model.predict(rows).select(*key, "predicted").collect()}
    assert walked == pytest.approx(scored) and len(scored) > 80
    shares = {r["feature"]: r["importance"] for r in trees.gain_shares(nodes, fv.FEATURE_COLUMNS).collect()}
    assert shares == pytest.approx({r["feature"]: r["importance"] for r in model.importances(spark).collect()})
    order = [r["feature"] for r in trees.gain_shares(nodes, fv.FEATURE_COLUMNS).orderBy(F.desc("importance"), "feature").limit(10).collect()]
    assert order[:3] == [r["feature"] for r in model.top_importances(spark).collect()][:3]


def test_nodes_of_a_model_without_splits(series, spark):
    rows = ft.build_features(series, ("tie",)).withColumn(fv.TARGET_COLUMN, F.lit(4))
    path = scratch_path(spark, "model")
    BoostedForecaster(trees=2, depth=2).train(rows).save(path)
    nodes = trees.node_table(spark, path)
    assert {r["predicted"] for r in trees.walk(rows, nodes, 2, ("part_number", "tie")).collect()} == {4.0}
    assert {r["importance"] for r in trees.gain_shares(nodes, ("lag_1", "month")).collect()} == {0.0}
    assert trees.walk(rows.limit(0), nodes, 2, ("part_number", "tie")).count() == 0


def test_boosted_trees_learn_the_weekday(spark):
    """Demand by weekday with some noise: lower errors than the previous row's on rows not trained on."""
    start = datetime.date(2015, 1, 1)
    days = [start + datetime.timedelta(days=i) for i in range(400)]
    rows = [("A", "NPI", "Europe", 10 * d.weekday() + (i * 7919) % 5, d, 1.0, "Thing", None, i) for i, d in enumerate(days)]
    schema = (
        "part_number string, demand_type string, region string, demand_quantity int, transaction_date date, "
        "unit_cost double, part_description string, npi_signal string, tie int"
    )
    features = ft.build_features(spark.createDataFrame(rows, schema), ("tie",))
    train, test = features.filter("tie < 320"), features.filter("tie >= 320")
    scored = BoostedForecaster(trees=5, depth=4).train(train).predict(test)
    stacked = ev.stack([ev.prediction_rows(scored, "trees", ("tie",)), ev.prediction_rows(predict_naive(test), "naive", ("tie",))])
    errors = {r["model"]: r for r in ev.model_metrics(stacked).collect()}
    assert errors["trees"]["mae"] < errors["naive"]["mae"] / 2 and errors["trees"]["rmse"] < errors["naive"]["rmse"] / 2


PREDICTIONS = "part_number string, demand_type string, transaction_date date, tie int, model string, actual double, predicted double"


@pytest.fixture(scope="module")
def predictions(spark):
    day = datetime.date(2020, 1, 1)
    rows = [
        ("a", "NPI", day, 1, "m", 10.0, 8.0), ("a", "NPI", day, 2, "m", 0.0, 3.0), ("b", "standard", day, 3, "m", 4.0, 5.0),
        ("a", "NPI", day, 1, fv.NAIVE_NAME, 10.0, 6.0), ("a", "NPI", day, 2, fv.NAIVE_NAME, 0.0, 3.0), ("b", "standard", day, 3, fv.NAIVE_NAME, 4.0, 8.0),
    ]
    return spark.createDataFrame(rows, PREDICTIONS)


def test_metrics(predictions):
    rows = {r["model"]: tuple(r)[1:] for r in ev.model_metrics(predictions).collect()}
    assert rows["m"] == (2.0, round(np.sqrt(14 / 3), 2), 22.5)
    assert rows[fv.NAIVE_NAME][2] == 70.0


def test_mape_without_demand_is_zero(predictions):
    only = predictions.filter("actual = 0")
    assert {r["mape"] for r in ev.model_metrics(only).collect()} == {0.0}


def test_part_metrics(predictions):
    rows = {r["part_number"]: tuple(r)[1:] for r in ev.part_metrics(predictions.filter("model = 'm'")).collect()}
    assert rows == {"a": ("NPI", 2.5, 20.0), "b": ("standard", 1.0, 25.0)}


def test_improvement_and_best(predictions):
    metrics = ev.model_metrics(predictions)
    (row,) = ev.improvement(metrics).collect()
    assert row["model"] == "m" and row["mape_improvement"] == pytest.approx(67.9)
    assert [tuple(r) for r in ev.best_models(metrics).collect()] == [("mae", "m", 2.0), ("mape", "m", 22.5)]


def test_summary_and_samples(predictions):
    mine = predictions.filter("model = 'm'")
    assert tuple(ev.forecast_summary(mine).first()) == (3, 4.67, 5.33, 2.0)
    assert ev.forecast_summary(mine, part="b").first()["total_predictions"] == 1
    rows = ev.sample_predictions(mine, ("transaction_date", "part_number", "tie"), n=2).collect()
    assert [(r["index"], r["part_number"], r["tie"]) for r in rows] == [(0, "a", 1), (1, "a", 2)]


def test_naive(series):
    rows = ft.build_features(series, ("tie",))
    assert predict_naive(rows).filter(F.col("predicted") != F.col("lag_1")).count() == 0


def test_long_part_without_training_rows(series):
    hot = ordering.hot_keys(series.select("part_number"), ["part_number"], 50)
    states = fit_seasonal(series.filter("part_number <> 'A'"), ("tie",), hot=hot, chunk_rows=20)
    assert sorted(r["part_number"] for r in states.collect()) == ["B", "C"]


def test_long_part_with_few_training_rows(series):
    hot = ordering.hot_keys(series.select("part_number"), ["part_number"], 50)
    few = series.filter("part_number = 'A' and tie < 5")
    check_states(fit_seasonal(few, ("tie",), hot=hot, chunk_rows=20), few)


def test_training_rows_are_spread_over_tasks(spark):
    from partflow.operators.models.boosted import spread

    rows = spark.range(1_000).coalesce(1)
    assert spread(rows, 100).rdd.getNumPartitions() == 10
    assert spread(rows, 1_000).rdd.getNumPartitions() == 1
    assert sorted(r["id"] for r in spread(rows, 300).collect()) == list(range(1_000))


@pytest.mark.parametrize("joint_rows", [1_000_000, 100])
@pytest.mark.parametrize("share", [0.8, 1.0])
def test_trees_are_those_of_spark(spark, monkeypatch, share, joint_rows):
    """Grown from histograms, features alone or several a column, trees are GBTRegressor's; more rows than the sample for thresholds."""
    from partflow.operators.models import boosted, histograms

    monkeypatch.setattr(histograms, "JOINT_ROWS", joint_rows)
    n, x = 12_000, F.col("id")
    rows = spark.range(0, n, 1, 3).select(
        *[(F.rand(i) * 100).alias(c) for i, c in enumerate(("lag_1", "lag_3", "unit_cost"))],
        (x % 7).cast("int").alias("day_of_week"),
        (x % 12 - 5).cast("int").alias("month"),
        (x % 5 == 0).cast("int").alias("is_weekend"),
        F.lit(3).alias("quarter"),
    )
    rows = rows.withColumn(fv.TARGET_COLUMN, (F.col("lag_1") * F.col("day_of_week") + F.col("lag_3") + F.rand(9) * 500).cast("int"))
    model = boosted.BoostedForecaster(trees=5, depth=4, row_share=share)
    names = [c for c in fv.FEATURE_COLUMNS if c in rows.columns]
    plain = model.pipeline(names).fit(rows.select(*names, F.col(fv.TARGET_COLUMN).cast("double").alias("_label")))
    model.train(rows)

    def nodes(saved):
        path = scratch_path(spark, "model")
        saved.write().save(path)
        return {(r["treeID"], r["nodeData"]["id"]): r["nodeData"] for r in spark.read.parquet(f"{path}/stages/1_*/data").collect()}

    want, got = nodes(plain), nodes(model.model)
    assert want.keys() == got.keys() and len(got) > 100
    for key, node in want.items():
        assert (node["split"], node["rawCount"], node["leftChild"], node["rightChild"]) == (got[key]["split"], got[key]["rawCount"], got[key]["leftChild"], got[key]["rightChild"])
        assert [got[key][c] for c in ("prediction", "impurity", "gain")] == pytest.approx([node[c] for c in ("prediction", "impurity", "gain")], rel=1e-6, abs=1e-6)
        assert got[key]["impurityStats"] == pytest.approx(node["impurityStats"], rel=1e-9, abs=1e-6)
    assert model.predict(rows).agg(F.sum("predicted")).first()[0] == pytest.approx(plain.transform(rows).agg(F.sum(F.greatest("predicted", F.lit(0.0)))).first()[0])


def test_training_takes_no_more_tasks_than_cores(spark):
    """A level of a tree was a pass of a task a partition; histograms now come one a core, whatever the partitions."""
    from partflow.operators.models import histograms

    rows = spark.range(0, 600, 1, 30).select((F.col("id") % 9).cast("double").alias("lag_1"), (F.col("id") % 4).cast("double").alias("_label"))
    seen, merged = [], histograms._merged
    histograms._merged = lambda sums: seen.append(sums.getNumPartitions()) or merged(sums)
    try:
        layout, grown = histograms.grow(rows, 600, ["lag_1"], "_label", 2, 2, 0.1, 0.8, 1)
    finally:
        histograms._merged = merged
    assert max(seen) <= spark.sparkContext.defaultParallelism and len(grown) == 2
    assert histograms.node_rows(0, grown[0], layout)[0][1][4] < 600


def test_rows_that_cannot_be_trained_on(spark):
    rows = spark.createDataFrame([(1.0, 2), (None, 3)], "lag_1 double, demand_quantity int")
    with pytest.raises(Exception, match="null"):
        BoostedForecaster(trees=1, depth=1).train(rows)
    with pytest.raises(ValueError, match="no rows"):
        BoostedForecaster(trees=1, depth=1).train(rows.limit(0))
