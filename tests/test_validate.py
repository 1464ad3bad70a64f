import json
import re

import pytest

from partflow import fixed_values as fv
from partflow.operators import validate as v
from partflow.plans.ingest import ingest
from tests.conftest import RECORD


def errors_of(df):
    return [r["errors"] for r in v.with_errors(df).orderBy("id").collect()]


def test_valid_record_passes(records):
    assert errors_of(records({})) == [[]]


@pytest.mark.parametrize(
    "field, value, named",
    [
        ("part_number", "", "part_number"),
        ("part_number", "   ", "part_number"),
        ("part_number", "\t\n\u00a0", "part_number"),
        ("part_number", None, "part_number"),
        ("demand_quantity", -5, "negative (got -5)"),
        ("demand_quantity", None, "demand_quantity must be an integer"),
        ("demand_type", "banana", "demand_type 'banana'"),
        ("demand_type", None, "demand_type 'None'"),
        ("region", "Mars", "region 'Mars'"),
        ("unit_cost", -5.0, "unit_cost must be positive (got -5.0)"),
        ("unit_cost", 0.0, "unit_cost must be positive (got 0.0)"),
        ("unit_cost", float("nan"), "unit_cost must be a number"),
        ("unit_cost", None, "unit_cost must be a number"),
        ("transaction_date", "2015-13-45", "transaction_date '2015-13-45'"),
        ("transaction_date", "2015-02-30", "transaction_date"),
        ("transaction_date", "15-02-03", "transaction_date"),
        ("transaction_date", None, "transaction_date"),
        ("part_description", "", "part_description"),
    ],
)
def test_single_defect_is_named(records, field, value, named):
    (found,) = errors_of(records({field: value}))
    assert len(found) == 1 and named in found[0]


def test_boundary_values_pass(records):
    rows = [{"demand_quantity": 0}, {"npi_signal": None}, {"transaction_date": "2023-12-31"}, {"transaction_date": "2015-1-5"}]
    rows += [{"demand_type": t} for t in fv.DEMAND_TYPES] + [{"region": r} for r in fv.REGIONS]
    assert errors_of(records(*rows)) == [[]] * len(rows)


def test_text_quantities(records):
    df = records({"demand_quantity": " 42 "}, {"demand_quantity": "3.7"}, {"demand_quantity": "x"}, demand_quantity="string")
    assert [len(e) for e in errors_of(df)] == [0, 1, 1]


def test_fractions_truncate(records):
    df = v.coerce_fields(records({"demand_quantity": 3.7}, {"demand_quantity": -3.7}, demand_quantity="double"))
    assert [r["demand_quantity"] for r in df.orderBy("id").collect()] == [3, -3]


def test_text_cost_is_no_number_until_coerced(records):
    df = records({"unit_cost": "2.5"}, unit_cost="string")
    assert errors_of(df) == [["unit_cost must be a number"]]
    assert errors_of(v.coerce_fields(df)) == [[]]


def test_all_messages_of_a_row_are_kept(records):
    (found,) = errors_of(records({"demand_quantity": -1, "region": "Atlantis", "part_description": " "}))
    assert [m.split()[0] for m in found] == ["region", "demand_quantity", "part_description"]


def test_mixed_batch_splits(records):
    checked = v.with_errors(records({}, {}, {}, {"demand_quantity": -1}, {"region": "Atlantis"}))
    assert v.valid_rows(checked).count() == 3
    assert sorted(r["id"] for r in v.quarantine(checked, ("id",)).collect()) == [3, 4]


def test_error_row_and_text(records):
    bad = v.quarantine(v.with_errors(records({}, {"unit_cost": -10.0})), ("id",)).first()
    assert bad["id"] == 1
    assert bad["error"] == "Validation failed for record:\n  - unit_cost must be positive (got -10.0)"


@pytest.mark.parametrize("n", [0, 3])
def test_empty_and_all_bad(records, n):
    df = records({}, *[{"demand_quantity": -1}] * n).filter("id > 0")
    checked = v.with_errors(df)
    assert v.valid_rows(checked).count() == 0
    assert v.quarantine(checked, ("id",)).count() == n
    report = v.run_report(checked, list(fv.DEMAND_COLUMNS)).first()
    assert (report["total_records"], report["rejected_records"], report["pass_rate"]) == (n, n, 0.0)


def test_report(records):
    checked = v.with_errors(records({}, {"npi_signal": None}, {"region": "Atlantis"}))
    row = v.run_report(checked, list(fv.DEMAND_COLUMNS)).first()
    assert tuple(row) == (3, 2, 1, 66.7, 1)
    skipped = v.run_report(checked.drop("errors"), list(fv.DEMAND_COLUMNS), validate=False).first()
    assert tuple(skipped) == (3, 3, 0, 100.0, 1)


def test_first_errors_are_cut(records):
    checked = v.with_errors(records(*[{"region": "Atlantis", "demand_quantity": -i - 1} for i in range(5)]))
    first = v.first_errors(v.quarantine(checked, ("id",)), ("id",)).collect()
    assert [r["id"] for r in first] == [0, 1, 2]
    assert all(len(r["error"]) == 100 for r in first)


def test_schema_is_checked(records):
    df = records({})
    v.check_schema(df, extra=("id",))
    v.check_schema(df.drop("npi_signal"), extra=("id",))
    with pytest.raises(ValueError, match="unit_cost"):
        v.check_schema(df.drop("unit_cost"), extra=("id",))
    with pytest.raises(ValueError, match="id"):
        v.check_schema(df)


def open_errors(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, record string")
    return v.with_open_errors(v.open_records(df))


def text(**changes):
    record = {**RECORD, **changes}
    return json.dumps({k: x for k, x in record.items() if x is not ...})


def test_records_with_fields_of_their_own(spark):
    checked = open_errors(
        spark,
        text(),
        text(npi_signal=...),
        text(unit_cost=..., region=...),
        text(store="S", area=1),
        text(extra=None, part_number=..., demand_quantity=-1),
        text(demand_quantity=-1, npi_signal=None),
        text(unit_cost="2.5"),
        text(demand_quantity="abc"),
        text(demand_quantity=3.7),
        text(part_number=None, region={"a": 1}),
    )
    found = {r["id"]: r["errors"] for r in checked.collect()}
    assert found[0] == found[1] == []
    assert found[2] == ["missing required field 'region'", "missing required field 'unit_cost'"]
    assert found[3] == ["unexpected field 'area'", "unexpected field 'store'"]
    assert found[4] == ["unexpected field 'extra'", "missing required field 'part_number'"]
    assert found[5] == ["demand_quantity cannot be negative (got -1)"]
    assert found[6] == ["unit_cost must be a number"]
    assert found[7] == found[8] == ["demand_quantity must be an integer"]
    assert [m.split()[0] for m in found[9]] == ["part_number", "region"]
    kept = v.valid_rows(checked).orderBy("id").collect()
    assert [(r["id"], r["demand_quantity"], r["unit_cost"], r["npi_signal"]) for r in kept] == [(0, 42, 12.99, "Launch"), (1, 42, 12.99, None)]


def test_texts_that_are_no_records(spark):
    texts = (None, "", "{", "[1]", "3", "null", '{"region": 1, "region": 2}', text()[:-1])
    found = [r["errors"] for r in open_errors(spark, *texts).collect()]
    assert found == [["record must be an object of distinct fields"]] * len(texts)
    assert open_errors(spark, "{}").first()["errors"] == [f"missing required field '{c}'" for c in fv.DEMAND_COLUMNS if c != "npi_signal"]
    assert open_errors(spark).count() == 0


def test_checks_of_an_ingest_run_once(spark, records):
    """Valid rows, rejects and report read one tagged table; none of their plans holds a check."""
    done = ingest(records({}, {"region": "Mars"}, {"demand_quantity": -1}), ("id",))
    assert (done.valid.count(), sorted(r["id"] for r in done.rejected.collect())) == (1, [1, 2])
    assert tuple(done.report.first())[:4] == (3, 1, 2, 33.3)
    for frame in (done.valid, done.rejected, done.report):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "must be" not in plan and "parquet" in plan
    assert "outcome" not in done.valid.columns


def test_open_records_are_parsed_once(spark):
    """However often conditions and messages mention a field, the plan parses a record in one place."""
    rows = [(1, '{"part_number": "P", "unit_cost": -1.5, "more": 1}'), (2, "[1]"), (3, None)]
    records = spark.createDataFrame(rows, "order_key int, record string").repartition(2)
    bad = v.quarantine(v.with_open_errors(v.open_records(records)), ("order_key",))
    plan = bad._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"parse_?json", plan, re.IGNORECASE)) == 1
    got = {r["order_key"]: r["errors"] for r in bad.collect()}
    assert got[2] == got[3] and len(got[2]) == 1 and len(got[1]) > 1
