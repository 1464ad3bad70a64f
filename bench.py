"""Time the headline queries: one JSON line.

Reads $BENCH_SF_DIR on local[$BENCH_CPUS]. Every query is executed in full into
a sink that drops the rows. ``phase_*`` entries build the tables that later
phases read (demand, features, states, predictions, chunks), as separate jobs
would; the other entries read the raw tables or those phase tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harness.binding import phases  # noqa: E402
from harness.catalog import QUERIES  # noqa: E402
from partflow.session import get_spark  # noqa: E402

PHASES = ("demand", "features", "cut", "states", "predictions", "chunks")
HEADLINE = (
    "conform", "price_join", "avg_price", "recode_default", "date_features", "quality_flags", "dataset_summary",
    "validate_valid", "validate_errors", "validation_report",
    "lag_features", "rolling_features", "features_complete", "time_split", "demand_trend", "naive_fallback",
    "fit_seasonal", "forecast_seasonal", "model_metrics", "per_part_metrics", "model_improvement",
    "part_profile", "stockout_risk", "part_chunks", "kb_all_chunks", "demand_by_type", "risk_buckets",
    "query_terms", "question_intent", "kb_keyword_search", "document_keyword_search", "vector_search", "answer_batch",
    "embed_chunks", "forecast_gbt", "validate_error_rows", "price_join_weekly", "answer_batch_vector", "answer_user_turns",
    "gen_demand", "model_metrics_all",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else 8,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark.read.parquet(f"{sf_dir}/nation.parquet").groupBy("n_regionkey").count())
    spent: dict[str, float] = {}
    tables = phases(spark, sf_dir)
    for name in PHASES:
        start = time.perf_counter()
        getattr(tables, name)()
        spent[f"phase_{name}"] = round(time.perf_counter() - start, 3)
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        spent[name] = round(time.perf_counter() - start, 3)
    total = round(sum(spent.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/"))
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": spent, "sf": scale}))


if __name__ == "__main__":
    main()
