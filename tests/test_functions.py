import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from partflow.functions import numbers as n
from partflow.functions import text as t
from partflow.functions.calendar import parse_date

FEW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


@FEW
@given(st.lists(st.floats(-1e6, 1e6), min_size=50, max_size=200), st.integers(0, 3))
def test_rounding_agrees_with_numpy(spark, values, digits):
    values += [12.25, 0.125, 2.5, -2.25, 1.005, 122.5]
    got = column(spark, values, "double", lambda x: n.round_even(x, digits))
    assert got == [float(np.round(v, digits)) for v in values]


@FEW
@given(st.lists(st.floats(0, 1e9), min_size=50, max_size=200))
def test_number_texts_agree_with_python(spark, values):
    rounded = [float(np.round(v, 2)) for v in values]
    assert column(spark, rounded, "double", lambda x: n.short_text(x, 2)) == [str(v) for v in rounded]
    assert column(spark, rounded, "double", lambda x: n.signed_text(n.round_even(x, 1), 1)) == [f"{np.round(v, 1):+.1f}" for v in rounded]


def test_null_numbers_have_no_text(spark):
    for fn in (n.short_text, n.fixed_text, n.signed_text):
        assert column(spark, [None], "double", lambda x, fn=fn: fn(x, 1)) == [None]


@FEW
@given(st.lists(st.text(max_size=40), min_size=20, max_size=60))
def test_words_and_strip_agree_with_python(spark, values):
    values += ["", " \t\n", "a b c", "\x1ca\x1f", "　x "]
    values = [v.replace("\x00", "") for v in values]
    assert column(spark, values, "string", t.words) == [v.split() for v in values]
    assert column(spark, values, "string", t.strip) == [v.strip() for v in values]


def test_json_text_escapes(spark):
    import json

    values = ['a"b', "back\\slash", "é — ü", "line\nbreak", "", "\U0001f600"]
    got = column(spark, values, "string", t.json_text)
    assert [json.loads(g) for g in got] == values
    assert all(g.isascii() for g in got)


def test_sums_do_not_depend_on_order(spark):
    rng = np.random.default_rng(1)
    values = [float(v) for v in rng.uniform(0, 1e4, 2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    means = {df.repartition(k).agg(n.exact_mean(F.col("x"))).first()[0] for k in (1, 3, 8)}
    assert len(means) == 1 and math.isclose(means.pop(), float(np.mean(values)), rel_tol=1e-9)


@pytest.mark.parametrize("values", [[1, 2, 4], [5, 5], [3], [10] * 99 + [999]])
def test_sample_std(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x long")
    x = F.col("x")
    got = df.agg(n.sample_std(F.count(x), F.sum(x), F.sum(x * x))).first()[0]
    assert got is None if len(values) == 1 else got == pytest.approx(np.std(values, ddof=1))


@pytest.mark.parametrize(
    "text, ok",
    [
        ("2015-01-05", True), ("2015-1-5", True), ("2015-1- 5", True), ("2016-02-29", True), ("2015-02-29", False), ("2015-13-01", False),
        ("15-01-05", False), ("2015-01-05 ", False), ("2015-01-05T00:00:00", False), ("2015-01", False), ("0000-01-01", False), ("+2015-01-01", False), ("", False),
    ],
)
def test_dates(spark, text, ok):
    assert (column(spark, [text], "string", parse_date)[0] is not None) is ok


def test_sums_take_any_size(spark):
    rows = spark.createDataFrame([(1e-9,), (3e-9,)], "x double")
    assert rows.agg(n.exact_mean(F.col("x"))).first()[0] == 2e-9
    large = spark.createDataFrame([(1e24,), (1.0,), (None,), (-1e24,)], "x double")
    assert abs(large.agg(n.exact_sum(F.col("x"))).first()[0]) <= 1e9
    assert math.isnan(spark.createDataFrame([(float("nan"),), (1.0,)], "x double").agg(n.exact_sum(F.col("x"))).first()[0])
    assert spark.createDataFrame([(None,)], "x double").agg(n.exact_sum(F.col("x"))).first()[0] is None


def test_deviation_of_large_quantities(spark):
    rows = spark.createDataFrame([(2_000_000_000,)] * 4 + [(0,)], "x long")
    q = F.col("x")
    got = rows.agg(n.sample_std(F.count(q), n.whole_sum(q), n.square_sum(q))).first()[0]
    assert math.isclose(got, 894427190.99991588)
    one = spark.createDataFrame([(2_147_483_647,)] * 50, "x long")
    assert one.agg(n.sample_std(F.count(q), n.whole_sum(q), n.square_sum(q))).first()[0] == 0.0
