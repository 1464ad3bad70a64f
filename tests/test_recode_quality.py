import pytest
from pyspark.sql import functions as F

from partflow import fixed_values as fv
from partflow.operators import quality, recode

SALES = "item_id string, dept_id string, cat_id string, store_id string, date string, sales int, event_name_1 string"
PRICES = "item_id string, store_id string, wm_yr_wk int, sell_price double"


def conformed(spark, sale, price=None):
    prices = spark.createDataFrame([price] if price else [], PRICES)
    return recode.conform(spark.createDataFrame([sale], SALES), prices)


def test_maps_are_complete_and_valid():
    assert set(fv.DEPT_TO_DEMAND_TYPE) == {"HOBBIES_1", "HOBBIES_2", "HOUSEHOLD_1", "HOUSEHOLD_2", "FOODS_1", "FOODS_2", "FOODS_3"}
    assert len(fv.STORE_TO_REGION) == 10
    assert set(fv.DEPT_TO_DEMAND_TYPE.values()) <= set(fv.DEMAND_TYPES)
    assert set(fv.STORE_TO_REGION.values()) <= set(fv.REGIONS)


def test_conform_columns(spark):
    df = conformed(spark, ("HOBBIES_1_001", "HOBBIES_1", "HOBBIES", "CA_1", "2015-01-01", 5, "SuperBowl"), ("HOBBIES_1_001", "CA_1", 11101, 9.99))
    assert df.columns == list(fv.DEMAND_COLUMNS)
    row = df.first()
    assert (row["unit_cost"], row["npi_signal"]) == (9.99, "AMAT_TechNode_3nm_Launch")


def test_conform_values(spark):
    row = conformed(spark, ("FOODS_3_042", "FOODS_3", "FOODS", "WI_3", "2015-03-10", 8, None), ("FOODS_3_042", "WI_3", 11101, 4.5)).first()
    assert (row["part_number"], row["demand_type"], row["region"], row["demand_quantity"]) == (
        "AMAT-ETCH-6600-RING", "reliability", "Europe", 8,
    )


def test_misses(spark):
    row = conformed(spark, ("X_1", "TOYS", "TOYS", "NY_1", "2015-03-10", 8, "Parade")).first()
    assert tuple(row) == ("X_1", "standard", "North America", 8, "2015-03-10", 0.01, "TOYS", None)


def test_columns_that_are_absent_are_skipped(spark):
    sales = spark.createDataFrame([("X_1", "TOYS", "TOYS", "NY_1", 8)], "item_id string, dept_id string, cat_id string, store_id string, sales int")
    df = recode.conform(sales, spark.createDataFrame([], PRICES))
    assert df.columns == ["part_number", "demand_type", "region", "demand_quantity", "unit_cost", "part_description"]


def test_price_branches(spark):
    sales = spark.createDataFrame([("i", "s", 7)], "item_id string, store_id string, wm_yr_wk int")
    prices = spark.createDataFrame([("i", "s", 7, 3.0), ("i", "s", 8, 5.0)], PRICES)
    assert recode.attach_prices(sales.drop("wm_yr_wk"), prices, {}).first()["sell_price"] == 4.0
    assert recode.attach_prices(sales, prices, {}).first()["sell_price"] == 0.01
    assert recode.attach_prices(sales.drop("wm_yr_wk"), prices.drop("sell_price"), {}).first()["sell_price"] == 0.01
    assert recode.attach_weekly_prices(sales, prices).first()["sell_price"] == 3.0


def test_large_dictionary_is_joined(spark):
    mapping = {f"k{i}": f"v{i}" for i in range(500)}
    df = spark.createDataFrame([("k499",), ("zzz",), (None,)], "k string")
    out = recode.recode(df, "k", "v", mapping, F.lit("none"))
    assert sorted(r["v"] for r in out.collect()) == ["none", "none", "v499"]
    kept = recode.recode(df, "k", "k", mapping, F.col("k"))
    assert {r["k"] for r in kept.collect()} == {"v499", "zzz", None}


def flags(spark, quantities, signal=None):
    df = spark.createDataFrame([(i, x, signal) for i, x in enumerate(quantities)], "i int, demand_quantity int, npi_signal string")
    return quality.quality_flags(df).orderBy("i").collect()


def test_zero_and_signal_flags(spark):
    rows = flags(spark, [0, 10])
    assert [r["is_zero_demand"] for r in rows] == [1, 0]
    assert [r["has_npi_signal"] for r in rows] == [0, 0]
    assert flags(spark, [1], "Launch")[0]["has_npi_signal"] == 1


@pytest.mark.parametrize("quantities, flagged", [([10] * 99 + [999], [999]), ([10], []), ([5, 5, 5], [])])
def test_outlier_flag(spark, quantities, flagged):
    assert [r["demand_quantity"] for r in flags(spark, quantities) if r["is_demand_outlier"]] == flagged


def test_summary_and_shares(spark):
    rows = [("a", "Europe", "NPI", "2015-01-01", None, 1, 0, 0), ("b", "Europe", "NPI", "2015-01-03", "x", 0, 1, 1), ("b", "Asia Pacific", "standard", "2015-01-02", None, 0, 0, 0)]
    df = spark.createDataFrame(rows, "part_number string, region string, demand_type string, transaction_date string, npi_signal string, is_zero_demand int, is_demand_outlier int, has_npi_signal int")
    assert tuple(quality.dataset_summary(df).first()) == (3, "2015-01-01", "2015-01-03", 2, 2, 1, 1, 1, 2)
    assert [tuple(r) for r in quality.value_share(df, "region").collect()] == [("Europe", 2, 66.7), ("Asia Pacific", 1, 33.3)]


def test_long_texts_stay_out_of_the_price_join(spark):
    from partflow.operators.recode import conform as conformed

    sales = spark.createDataFrame([("i", "d", "c", "s", 3)], "item_id string, dept_id string, cat_id string, store_id string, sales int")
    prices = spark.createDataFrame([("i", "s", 1, 2.5)], "item_id string, store_id string, wm_yr_wk int, sell_price double")
    got = conformed(sales, prices, category_map={"c": "a text of some length"})
    assert [(r["part_description"], r["unit_cost"]) for r in got.collect()] == [("a text of some length", 2.5)]
    lines = got._jdf.queryExecution().optimizedPlan().toString().split("\n")
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    texts = [i for i, line in enumerate(lines) if "a text of some length" in line]
    assert texts and max(texts) < join
