"""Raw tables to validated demand records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow import fixed_values as fv
from partflow.operators.quality import dataset_summary, quality_flags, value_share
from partflow.operators.recode import conform
from partflow.operators.validate import check_schema, coerce_fields, quarantine, run_report, valid_rows, with_errors
from partflow.session import materialize
from partflow.sources.tables import load_raw, write_csv, write_table

FLAGS = ("is_zero_demand", "is_demand_outlier", "has_npi_signal")


@dataclass(frozen=True)
class Ingested:
    """``mapped`` has the flags, ``report`` the totals of the run."""

    mapped: DataFrame
    valid: DataFrame
    rejected: DataFrame | None
    report: DataFrame


def preprocess(sales: DataFrame, prices: DataFrame, keep: tuple[str, ...] = (), **maps) -> DataFrame:
    """Demand records with quality flags."""
    return quality_flags(materialize(conform(sales, prices, keep, **maps), "conformed"))


def ingest(mapped: DataFrame, key: tuple[str, ...], validate: bool = True) -> Ingested:
    """Check every record once; valid rows and rejects read the same result."""
    check_schema(mapped, extra=(*key, *FLAGS))
    if not validate:
        return Ingested(mapped, mapped, None, run_report(mapped, validate=False))
    # One tagged write: each output reads its own folder of it.
    outcome = F.when(F.size("errors") > 0, "rejected").otherwise("valid")
    checked = materialize(with_errors(coerce_fields(mapped)).withColumn("outcome", outcome), "checked", "outcome")
    valid, rejected = (checked.filter(F.col("outcome") == o).drop("outcome") for o in ("valid", "rejected"))
    columns = [c for c in mapped.columns if c not in key or c in fv.DEMAND_COLUMNS]
    return Ingested(mapped, valid_rows(valid), quarantine(rejected, key), run_report(checked.drop("outcome"), columns))


def run_ingest(spark: SparkSession, input_dir: str, output_dir: str, validate: bool = True, csv: bool = True) -> Ingested:
    """CSV in, tables out; returns the frames of the run.

    The conformed rows are stored once, as the outlier limit needs them before
    any output does; ``session.clear_scratch`` removes them after the run.

    The store is carried along as the tie-break of a part's rows on one day.
    """
    sales, prices, _ = load_raw(spark, input_dir)
    mapped = preprocess(sales, prices, keep=("store_id",))
    done = ingest(mapped, ("part_number", "store_id", "transaction_date"), validate)
    write_table(done.valid, f"{output_dir}/validated", "demand_type")
    if done.rejected is not None:
        write_table(done.rejected, f"{output_dir}/rejected")
    if csv:
        write_csv(mapped, f"{output_dir}/mapped_csv")
        write_csv(done.valid, f"{output_dir}/validated_csv")
        if done.rejected is not None:
            write_csv(done.rejected.drop("errors"), f"{output_dir}/validation_errors_csv")
    return done


def summaries(mapped: DataFrame) -> dict[str, DataFrame]:
    return {
        "dataset": dataset_summary(mapped),
        "demand_type": value_share(mapped, "demand_type"),
        "region": value_share(mapped, "region"),
    }
