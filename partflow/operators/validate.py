"""Record checks, the valid/quarantine split and the run report.

Every check looks at every row, and a row keeps all of its messages. All of it
is column expressions: one narrow pass, no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow import fixed_values as fv
from partflow.functions.calendar import parse_date, valid_date
from partflow.functions.numbers import round_even
from partflow.functions.text import has_ink
from partflow.operators.quality import null_cells

MSG = fv.CHECK_MESSAGES
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
REAL = (T.FloatType, T.DoubleType)


def _type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def _shown(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def coerce_fields(df: DataFrame) -> DataFrame:
    """Cast every field to its type before the checks.

    Quantities are truncated towards zero, the signal stays null where null,
    and what cannot be cast becomes null so that the checks reject it.
    """
    q = F.col("demand_quantity")
    if isinstance(_type(df, "demand_quantity"), REAL):
        quantity = F.when(~F.isnan(q), q).try_cast("int")
    else:
        quantity = q.try_cast("int")
    casts = {c: F.col(c).cast("string") for c in ("part_number", "demand_type", "region", "part_description")}
    casts["npi_signal"] = F.col("npi_signal").cast("string") if "npi_signal" in df.columns else F.lit(None).cast("string")
    casts["demand_quantity"] = quantity
    casts["unit_cost"] = F.col("unit_cost").try_cast("double")
    casts["transaction_date"] = F.col("transaction_date").cast("string")
    return df.withColumns(casts)


def _quantity_value(df: DataFrame) -> Column:
    """The quantity as a whole number, or null where it is none."""
    q, kind = F.col("demand_quantity"), _type(df, "demand_quantity")
    if isinstance(kind, REAL):
        return F.when(~F.isnan(q), q).try_cast("long")
    if isinstance(kind, NUMERIC):
        return q.try_cast("long")
    text = q.cast("string")
    return F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(text).try_cast("long"))


def record_checks(df: DataFrame) -> list[tuple[Column, Column]]:
    """(is bad, message) pairs in the order of the checks; never null."""

    def blank(name: str) -> Column:
        return ~F.coalesce(has_ink(F.col(name).cast("string")), F.lit(False))

    def outside(name: str, allowed) -> Column:
        return ~F.coalesce(F.col(name).isin(*allowed), F.lit(False))

    quantity = _quantity_value(df)
    cost = F.col("unit_cost")
    if isinstance(_type(df, "unit_cost"), NUMERIC):
        cost_missing = cost.isNull()
        if isinstance(_type(df, "unit_cost"), REAL):
            cost_missing = cost_missing | F.isnan(cost)
        cost_low = ~cost_missing & (cost <= 0)
    else:
        cost_missing, cost_low = F.lit(True), F.lit(False)
    date_text = F.col("transaction_date").cast("string")

    shown_type, shown_region = _shown(F.col("demand_type")), _shown(F.col("region"))
    return [
        (blank("part_number"), F.lit(MSG["part_number"])),
        (outside("demand_type", fv.DEMAND_TYPES), F.format_string(MSG["demand_type"], shown_type)),
        (outside("region", fv.REGIONS), F.format_string(MSG["region"], shown_region)),
        (quantity.isNull(), F.lit(MSG["quantity_type"])),
        (F.coalesce(quantity < 0, F.lit(False)), F.format_string(MSG["quantity_sign"], quantity.cast("string"))),
        (cost_missing, F.lit(MSG["cost_type"])),
        (F.coalesce(cost_low, F.lit(False)), F.format_string(MSG["cost_sign"], cost.cast("string"))),
        (~valid_date(date_text), F.format_string(MSG["date"], _shown(date_text))),
        (blank("part_description"), F.lit(MSG["part_description"])),
    ]


def is_invalid(df: DataFrame) -> Column:
    """Any check fails. Plain conditions that compile into the scan's stage."""
    return reduce(lambda a, b: a | b, [bad for bad, _ in record_checks(df)])


def record_errors(df: DataFrame) -> Column:
    """All messages of a row; they are only put together for a bad row."""
    found = F.array(*[F.when(bad, message) for bad, message in record_checks(df)])
    messages = F.filter(found, lambda m: m.isNotNull())
    return F.when(is_invalid(df), messages).otherwise(F.array().cast("array<string>"))


def check_schema(df: DataFrame, extra: tuple[str, ...] = ()) -> None:
    """A frame that lacks a field, or has one nobody knows, is refused whole."""
    missing = [c for c in fv.DEMAND_COLUMNS if c not in df.columns and c != "npi_signal"]
    unknown = [c for c in df.columns if c not in fv.DEMAND_COLUMNS and c not in extra]
    if missing or unknown:
        raise ValueError(f"demand record: missing fields {missing}, unexpected fields {unknown}")


def _worked_out(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` and the columns, worked out once a row.

    A plain projection is repeated in every condition that is pushed below it,
    once for each mention; what a generator returns is not.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def open_records(df: DataFrame, record: str = "record") -> DataFrame:
    """JSON records to the fields of a demand record and ``field_errors``; other columns carried.

    Every record brings its own fields: those it lacks and those nobody knows
    are named in its errors. A text that is no object, or names a field twice,
    is an error of its own. A cost that is a text stays no number.
    """
    carried = [c for c in df.columns if c not in (record, *fv.DEMAND_COLUMNS, "field_errors")]
    # The text, what it holds, and its fields are each made once.
    texts = _worked_out(df, carried, _record=F.col(record))
    parsed = _worked_out(texts, carried, _value=F.try_parse_json("_record"), _names=F.json_object_keys("_record"))
    value, names = F.col("_value"), F.col("_names")

    def field(name: str, kind: str) -> Column:
        return F.try_variant_get(value, f"$.{name}", kind)

    cost_kind = F.schema_of_variant(field("unit_cost", "variant"))
    typed = {c: field(c, "string") for c in fv.DEMAND_COLUMNS}
    typed["unit_cost"] = F.when(cost_kind != "STRING", field("unit_cost", "double"))
    lacking = F.array(*[F.lit(c) for c in fv.DEMAND_COLUMNS if c != fv.OPTIONAL_FIELD])
    unknown = F.array_sort(F.array_except(names, F.array(*[F.lit(c) for c in fv.DEMAND_COLUMNS])))
    found = F.concat(
        F.transform(unknown, lambda c: F.format_string(MSG["unknown_field"], c)),
        F.transform(F.array_except(lacking, names), lambda c: F.format_string(MSG["missing_field"], c)),
    )
    whole = value.isNotNull() & names.isNotNull()
    errors = F.when(whole, found).otherwise(F.array(F.lit(MSG["no_record"])))
    return _worked_out(parsed, carried, **typed, field_errors=errors)


def with_open_errors(records: DataFrame) -> DataFrame:
    """``errors`` of ``open_records``: a record of other fields is not looked at any further."""
    fields = F.col("field_errors")
    return records.withColumn("errors", F.when(F.size(fields) > 0, fields).otherwise(record_errors(records))).drop("field_errors")


def with_errors(df: DataFrame) -> DataFrame:
    """Append ``errors``: the messages, empty for a valid row."""
    return df.withColumn("errors", record_errors(df))


def valid_rows(records: DataFrame) -> DataFrame:
    """Valid records with a typed date and quantity; other columns carried.

    Takes records with or without the ``errors`` of ``with_errors``.
    """
    bad = F.size("errors") > 0 if "errors" in records.columns else is_invalid(records)
    typed = {
        "demand_quantity": _quantity_value(records).try_cast("int"),
        "transaction_date": parse_date(F.col("transaction_date").cast("string")),
    }
    return records.filter(~bad).withColumns(typed).drop("errors")


def quarantine(records: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rejected rows: their key, the messages and the error text.

    Takes records with or without the ``errors`` of ``with_errors``.
    """
    if "errors" in records.columns:
        bad = records.filter(F.size("errors") > 0)
    else:
        bad = with_errors(records.filter(is_invalid(records)))
    return bad.select(*key, F.col("errors"), error_text(F.col("errors")).alias("error"))


def error_text(errors: Column) -> Column:
    """The messages of a row as the one text that goes to the error log."""
    lines = F.transform(errors, lambda m: F.concat(F.lit("  - "), m))
    return F.concat(F.lit(fv.CHECK_HEADER + "\n"), F.array_join(lines, "\n"))


def first_errors(rejected: DataFrame, key: tuple[str, ...], n: int = 3, width: int = 100) -> DataFrame:
    """The first ``n`` errors in key order, cut to ``width`` characters."""
    return rejected.orderBy(*key).limit(n).select(*key, F.substring("error", 1, width).alias("error"))


def run_report(records: DataFrame, columns: list[str] | None = None, validate: bool = True) -> DataFrame:
    """Totals of a run in one pass; without validation every row counts as valid.

    Takes records with or without the ``errors`` of ``with_errors``.
    """
    columns = columns or [c for c in records.columns if c != "errors"]
    if not validate:
        ok = F.lit(1).cast("long")
    elif "errors" in records.columns:
        ok = (F.size("errors") == 0).cast("long")
    else:
        ok = (~is_invalid(records)).cast("long")
    sums = records.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.coalesce(F.sum(ok), F.lit(0)).alias("valid_records"),
        F.coalesce(F.sum(null_cells(columns)), F.lit(0)).alias("null_values"),
    )
    rate = F.when(F.col("total_records") > 0, F.col("valid_records") / F.col("total_records") * 100)
    return sums.select(
        "total_records",
        "valid_records",
        (F.col("total_records") - F.col("valid_records")).alias("rejected_records"),
        round_even(F.coalesce(rate, F.lit(0.0)), 1).alias("pass_rate"),
        "null_values",
    )
