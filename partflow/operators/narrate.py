"""Profiles and metrics told as text chunks; the knowledge base.

A chunk has ``id``, ``text``, ``source``, ``metadata`` (map of strings), the
typed ``avg_demand`` and ``best_mae``, ``metadata_json`` (the metadata as
written to JSON, numbers unquoted), ``string_values`` (metadata values that are
strings), and ``kind``/``seq``, which give the chunks their fixed order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow import fixed_values as fv
from partflow.functions.numbers import fixed_text, short_text, signed_text
from partflow.functions.text import fill, json_object, json_text

CHUNK_COLUMNS = (
    "id", "text", "source", "metadata", "avg_demand", "best_mae", "metadata_json", "string_values", "kind", "seq",
)
PART_SOURCE, MODEL_SOURCE, DOMAIN_SOURCE = "part_profile", "model_summary", "domain_knowledge"


def _chunk(df: DataFrame, kind: int, seq: Column, id_: Column, text: Column, fields: list, avg=None, best=None) -> DataFrame:
    """``fields`` are (key, column, is_text) in the order of the metadata."""
    null = F.lit(None).cast("double")
    return df.select(
        id_.alias("id"),
        text.alias("text"),
        next(c for k, c, _ in fields if k == "source").alias("source"),
        F.create_map(*[x for k, c, _ in fields for x in (F.lit(k), c)]).alias("metadata"),
        (null if avg is None else avg).alias("avg_demand"),
        (null if best is None else best).alias("best_mae"),
        json_object([(k, json_text(c) if is_text else c) for k, c, is_text in fields]).alias("metadata_json"),
        F.array(*[c for _, c, is_text in fields if is_text]).alias("string_values"),
        F.lit(kind).alias("kind"),
        seq.alias("seq"),
    )


def part_chunks(profiles: DataFrame, model: str = fv.BOOSTED_NAME) -> DataFrame:
    """One chunk per part."""
    marks = {
        "part": F.col("part_number"),
        "demand_type": F.col("demand_type"),
        "region": F.col("region"),
        "avg": short_text(F.col("avg_demand"), 1),
        "min": F.col("min_demand"),
        "max": F.col("max_demand"),
        "first": F.col("first_date"),
        "last": F.col("last_date"),
        "total": F.col("total_demand"),
        "volatility": F.col("volatility"),
        "trend": F.col("trend"),
        "trend_pct": signed_text(F.col("trend_pct"), 1),
        "roll_mean": short_text(F.col("rolling_mean_7"), 1),
        "roll_std": short_text(F.col("rolling_std_7"), 1),
        "model": F.lit(model),
        "mae": F.coalesce(short_text(F.col("mae"), 2), F.lit("N/A")),
        "mape": F.coalesce(short_text(F.col("mape"), 1), F.lit("N/A")),
        "cost": fixed_text(F.col("unit_cost"), 2),
        "signal_days": F.col("npi_days"),
        "days": F.col("n_days"),
        "signal_pct": short_text(F.col("npi_pct"), 1),
        "risk": F.col("risk_text"),
        "advice": F.col("advice"),
    }
    text = fill("\n\n".join(fv.PART_PARAGRAPHS), **marks)
    fields = [
        ("part_number", F.col("part_number"), True),
        ("demand_type", F.col("demand_type"), True),
        ("region", F.col("region"), True),
        ("avg_demand", short_text(F.col("avg_demand"), 1), False),
        ("trend", F.col("trend"), True),
        ("stockout_risk", F.col("stockout_risk"), True),
        ("source", F.lit(PART_SOURCE), True),
    ]
    id_ = F.concat(F.lit("part_"), F.col("part_number"))
    return _chunk(profiles, 0, F.col("part_number"), id_, text, fields, avg=F.col("avg_demand"))


def summary_chunk(
    metrics: DataFrame,
    model_order: tuple[str, ...] = (fv.BOOSTED_NAME, fv.SEASONAL_NAME, fv.NAIVE_NAME),
    baseline: str = fv.NAIVE_NAME,
    importances: DataFrame | None = None,
) -> DataFrame:
    """The model comparison as one chunk. ``metrics`` has a row per model.

    The gain over the baseline and the top features are computed; without
    ``importances`` the feature sentence is left out.
    """
    rank = F.coalesce(
        *[F.when(F.col("model") == m, F.lit(i)) for i, m in enumerate(model_order)], F.lit(len(model_order))
    )
    line = fill(
        fv.SUMMARY_LINE,
        model=F.col("model"),
        mae=short_text(F.col("mae"), 2),
        rmse=short_text(F.col("rmse"), 2),
        mape=short_text(F.col("mape"), 1),
    )
    # A handful of rows: one per model.
    folded = metrics.agg(
        F.sort_array(F.collect_list(F.struct(rank.alias("r"), F.col("model").alias("m"), line.alias("line")))).alias("lines"),
        F.min(F.struct(F.col("mae"), rank.alias("r"), F.col("model"))).alias("best"),
        F.max(F.when(F.col("model") == baseline, F.col("mae"))).alias("base"),
    )
    gain = F.rint((1 - F.col("best.mae") / F.col("base")) * 100).cast("long")
    parts = [
        F.lit(fv.SUMMARY_HEADER),
        F.array_join(F.transform("lines", lambda x: x["line"]), "\n"),
        fill(fv.SUMMARY_BEST, model=F.col("best.model"), mae=short_text(F.col("best.mae"), 2)),
        F.when(
            (F.col("best.model") != baseline) & (F.col("base") > 0),
            fill(fv.SUMMARY_GAIN, model=F.col("best.model"), gain=gain),
        ),
    ]
    if importances is not None:
        share = short_text(F.rint(F.col("importance") * 1000) / 10, 1)
        top = importances.orderBy(F.desc("importance"), "feature").limit(3).agg(
            F.sort_array(F.collect_list(F.struct((-F.col("importance")).alias("i"), "feature", share.alias("s")))).alias("top")
        )
        folded = folded.withColumn("top", top.scalar())
        entries = F.transform(
            "top",
            lambda x, i: F.concat(x["feature"], F.lit(" ("), x["s"], F.when(i == 0, F.lit("% importance)")).otherwise(F.lit("%)"))),
        )
        parts.append(fill(fv.SUMMARY_FEATURES, features=F.array_join(entries, ", ")))
    fields = [
        ("source", F.lit(MODEL_SOURCE), True),
        ("best_model", F.col("best.model"), True),
        ("best_mae", short_text(F.col("best.mae"), 2), False),
    ]
    text = F.concat_ws("\n\n", *parts)
    return _chunk(folded, 1, F.lit("0"), F.lit(fv.SUMMARY_ID), text, fields, best=F.col("best.mae"))


def domain_chunks(spark: SparkSession) -> DataFrame:
    """The four fixed notes, one per demand type."""
    rows = [(str(i), *note) for i, note in enumerate(fv.DOMAIN_NOTES)]
    notes = spark.createDataFrame(rows, "seq string, demand_type string, full_name string, description string")
    text = fill("Demand type: {t} ({n})\n\n{d}", t=F.col("demand_type"), n=F.col("full_name"), d=F.col("description"))
    fields = [("source", F.lit(DOMAIN_SOURCE), True), ("demand_type", F.col("demand_type"), True)]
    return _chunk(notes, 2, F.col("seq"), F.concat(F.lit("demand_type_"), F.col("demand_type")), text, fields)


def assemble(parts: DataFrame, summary: DataFrame, domain: DataFrame) -> DataFrame:
    return parts.unionByName(summary).unionByName(domain)


def chunk_counts(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("source").agg(F.count(F.lit(1)).alias("n_chunks"))
