import datetime

import pytest

from partflow.session import get_spark


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions=4,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


RECORD = {
    "part_number": "PART-1",
    "demand_type": "NPI",
    "region": "North America",
    "demand_quantity": 42,
    "transaction_date": "2015-06-15",
    "unit_cost": 12.99,
    "part_description": "RF & Lithography Components",
    "npi_signal": "Launch",
}
RECORD_SCHEMA = (
    "part_number string, demand_type string, region string, demand_quantity int, transaction_date string, "
    "unit_cost double, part_description string, npi_signal string"
)


@pytest.fixture
def records(spark):
    """Records that are valid but for the given overrides, with a row id."""

    def make(*overrides, **types):
        schema = ", ".join(
            f"{f.split()[0]} {types.get(f.split()[0], f.split()[1])}" for f in RECORD_SCHEMA.split(", ")
        )
        rows = [tuple({**RECORD, **o}.values()) + (i,) for i, o in enumerate(overrides)]
        return spark.createDataFrame(rows, schema + ", id int")

    return make


@pytest.fixture(scope="session")
def series(spark):
    """Three parts of 60, 25 and 7 rows, two rows a day, ties by ``tie``."""
    start, rows = datetime.date(2015, 1, 1), []
    for part, n in (("A", 60), ("B", 25), ("C", 7)):
        for i in range(n):
            quantity = (i * i * 7 + 3 * i + len(part) + n) % 23
            kind = "NPI" if part == "A" else "standard"
            region = ("North America", "Europe", "Asia Pacific")[i % 3]
            signal = "Launch" if i % 4 == 0 else None
            day = start + datetime.timedelta(days=i // 2)
            rows.append((part, kind, region, quantity, day, 1.5 + i % 2, "Thing", signal, i))
    schema = (
        "part_number string, demand_type string, region string, demand_quantity int, transaction_date date, "
        "unit_cost double, part_description string, npi_signal string, tie int"
    )
    return spark.createDataFrame(rows, schema).cache()
