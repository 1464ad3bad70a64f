import pytest

import __spark_entry__ as contract
from harness.catalog import QUERIES
from harness.compare import check, connect
from harness.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE])
def test_query_agrees_with_sql(spark, con, name):
    verdict, _, _ = check(spark, con, SF_DIR, name)
    assert verdict.startswith("ok"), verdict


def test_sample_demand_is_drawn_by_many_tasks(spark, tmp_path, monkeypatch):
    from harness import catalog

    spark.createDataFrame([(i, "SMALL X") for i in range(40)], "p_partkey long, p_type string").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(0, "ASIA"), (1, "EUROPE")], "r_regionkey long, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    monkeypatch.setattr(catalog, "SAMPLE_ROWS", 200, raising=False)
    rows = catalog.gen_demand(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() > 4 and rows.count() == rows.select("item_id", "store_id", "date").distinct().count()
