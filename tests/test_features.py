import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from partflow import fixed_values as fv
from partflow.operators import features as ft
from partflow.operators import ordering
from partflow.operators.models.naive import predict_previous_row
from partflow.operators.split import find_cut, fit_rows, holdout_rows, split_summary, with_split


def frame(df, by=("part_number", "transaction_date", "tie")):
    return df.toPandas().sort_values(list(by)).reset_index(drop=True)


def expected_features(series):
    pdf = frame(series)
    q = pdf.groupby("part_number")["demand_quantity"]
    for n in fv.LAGS:
        pdf[f"lag_{n}"] = q.shift(n)
    for name, rows, how in (
        ("rolling_mean_7", 7, "mean"), ("rolling_mean_14", 14, "mean"), ("rolling_std_7", 7, "std"),
        ("rolling_min_7", 7, "min"), ("rolling_max_7", 7, "max"),
    ):
        pdf[name] = q.transform(lambda x, r=rows, h=how: getattr(x.shift(1).rolling(r, min_periods=1), h)())
    pdf = pdf[pdf["lag_1"].notna()].fillna({c: 0 for c in pdf.columns if c.startswith(("lag_", "rolling_"))})
    return pdf.reset_index(drop=True)


def test_features_agree_with_pandas(series):
    got, want = frame(ft.build_features(series, ("tie",))), expected_features(series)
    assert len(got) == 60 + 25 + 7 - 3
    for c in [c for c in want.columns if c.startswith(("lag_", "rolling_"))]:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), atol=1e-9, err_msg=c)
    assert set(fv.FEATURE_COLUMNS) <= set(got.columns)


@pytest.mark.parametrize("chunk_rows", [14, 20, 1000])
def test_hot_parts_take_the_chunked_way(series, chunk_rows):
    hot = ordering.hot_keys(series.select("part_number"), ["part_number"], 20)
    assert {r["part_number"] for r in hot.collect()} == {"A", "B"}
    plain = frame(ft.build_features(series, ("tie",)))
    split = frame(ft.build_features(series, ("tie",), hot=hot, chunk_rows=chunk_rows))
    pd.testing.assert_frame_equal(plain, split[plain.columns])


def test_no_hot_parts_below_the_limit(series):
    assert ordering.hot_keys(series.select("part_number"), ["part_number"], 92) is None
    assert ordering.hot_keys(series.select("part_number"), ["part_number"], 60) is None


def test_one_shuffle_for_all_series_features(series):
    plan = ft.build_features(series, ("tie",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_day_grain(series):
    by_day = ft.by_day(series)
    assert by_day.filter("part_number = 'A'").count() == 30
    assert by_day.agg(F.sum("demand_quantity")).first()[0] == series.agg(F.sum("demand_quantity")).first()[0]
    assert ft.build_features(series, grain="day").filter("part_number = 'A'").count() == 29


def test_date_parts_agree_with_pandas(spark):
    days = pd.date_range("2014-12-20", "2017-01-10")
    df = spark.createDataFrame([(d.date(),) for d in days], "transaction_date date")
    got = ft.date_features(df).toPandas().sort_values("transaction_date")
    want = {
        "day_of_week": days.dayofweek, "day_of_month": days.day, "week_of_year": days.isocalendar().week,
        "month": days.month, "quarter": days.quarter, "is_weekend": days.dayofweek >= 5,
        "is_month_start": days.is_month_start, "is_month_end": days.is_month_end,
    }
    for name, values in want.items():
        assert list(got[name]) == [int(x) for x in values], name


def test_codes(spark):
    df = spark.createDataFrame([("reliability", "Europe", None), ("odd", None, "x")], "demand_type string, region string, npi_signal string")
    rows = ft.category_codes(df).orderBy("demand_type_encoded").collect()
    assert [(r["demand_type_encoded"], r["region_encoded"], r["has_npi_signal"]) for r in rows] == [(-1, -1, 1), (3, 2, 0)]


def test_positions_are_exact(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("k"))
    for group in ([], ["g"]):
        pdf = ordering.with_positions(df, group, ["k"]).toPandas()
        parts = [pdf] if not group else [p for _, p in pdf.groupby("g")]
        for p in parts:
            assert list(p.sort_values("k")["_pos"]) == list(range(len(p)))


def ranked(df):
    pdf = frame(df, ("transaction_date", "part_number", "tie"))
    cut = int(len(pdf) * 0.8)
    return pdf.iloc[:cut], pdf.iloc[cut:]


@pytest.mark.parametrize("rows_at_once", [1, 1000])
def test_split_is_exact(series, rows_at_once):
    cut = find_cut(series, ("part_number", "tie"), rows_at_once=rows_at_once)
    train, test = ranked(series)
    keys = ["part_number", "tie"]
    assert set(map(tuple, train[keys].values)) == {tuple(r) for r in fit_rows(series, cut).select(*keys).collect()}
    assert set(map(tuple, test[keys].values)) == {tuple(r) for r in holdout_rows(series, cut).select(*keys).collect()}
    assert with_split(series, cut).groupBy("split").count().count() == 2
    assert {r["split"]: r["n_rows"] for r in split_summary(series, cut).collect()} == {"train": 73, "test": 19}


@pytest.mark.parametrize("share", [0.0, 1.0, 0.5, 0.3])
def test_split_shares(series, share):
    cut = find_cut(series, ("part_number", "tie"), test_share=share)
    assert fit_rows(series, cut).count() == int(92 * (1 - share))
    assert holdout_rows(series, cut).count() == 92 - int(92 * (1 - share))


def test_split_inside_one_day(spark):
    day = datetime.date(2020, 1, 1)
    df = spark.createDataFrame([(f"p{i % 3}", i, day) for i in range(10)], "part_number string, tie int, transaction_date date")
    cut = find_cut(df, ("part_number", "tie"))
    assert cut.last is not None and fit_rows(df, cut).count() == 8


@pytest.mark.parametrize("first, value", [("zero", 0.0), ("own", None)])
def test_previous_row_fallback(series, first, value):
    order = ["transaction_date", "part_number", "tie"]
    got = frame(predict_previous_row(series, order, first, chunk_rows=10), order)
    want = got["demand_quantity"].shift(1)
    want[0] = got["demand_quantity"][0] if value is None else value
    assert list(got["predicted"]) == list(want)


def test_hot_parts_are_found_by_default(series):
    plain = frame(ft.build_features(series, ("tie",), hot=None))
    found = frame(ft.build_features(series, ("tie",), chunk_rows=20))
    pd.testing.assert_frame_equal(plain, found[plain.columns])
