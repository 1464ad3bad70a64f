"""The registered queries: one per operator, over whole test tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harness import binding as b
from partflow import fixed_values as fv
from partflow.functions.numbers import round_even
from partflow.operators import embedding, evaluate, features, narrate, profile, quality, recode, reports, retrieve, split, validate
from partflow.operators.answers import answer_by_vectors, answer_table, context_and_prompt
from partflow.operators.models import trees
from partflow.operators.models.boosted import BoostedForecaster
from partflow.operators.models.naive import predict_naive, predict_previous_row
from partflow.operators.models.seasonal import fit_seasonal as fit_seasonal_states
from partflow.operators.models.seasonal import predict_seasonal
from partflow.operators.ordering import number_rows
from partflow.session import materialize, scratch_path
from partflow.sources import sample, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Rows of sample demand that one task draws.
SAMPLE_ROWS = 500_000


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(name: str):
    """A double as it is compared: six decimals."""
    return round_even(F.col(name), 6).alias(name)


# Sources and sinks


@query
def scan_csv_roundtrip(spark, sf_dir):
    """All sales as CSV, scanned with the declared schema."""
    path = scratch_path(spark, "sales-csv")
    sales = b.raw_sales(spark, sf_dir).withColumns(
        {"state_id": F.lit(None).cast("string"), "date": F.date_format("date", "yyyy-MM-dd")}
    )
    tables.write_csv(sales.drop(*b.TIES), path)
    read = tables.read_sales(spark, path)
    return read.groupBy("store_id", "event_name_1").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("sales").alias("total_sales"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


@query
def scan_parquet_dates(spark, sf_dir):
    """Types survive a written intermediate table: dates need no parsing."""
    again = materialize(b.demand_series(spark, sf_dir), "series")
    return again.groupBy(F.year("transaction_date").alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("transaction_date").alias("first_date"),
        F.max("transaction_date").alias("last_date"),
    )


@query
def sink_partitioned(spark, sf_dir):
    path = scratch_path(spark, "demand-by-type")
    tables.write_table(b.phases(spark, sf_dir).demand(), path, "demand_type")
    return spark.read.parquet(path).groupBy("demand_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("demand_quantity").alias("total_demand")
    )


@query
def kb_json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "chunks-json")
    tables.write_chunks(b.phases(spark, sf_dir).chunks(), path)
    meta = F.col("metadata")
    return tables.read_chunks(spark, path).select(
        "id",
        "text",
        "source",
        meta["demand_type"].alias("demand_type"),
        meta["avg_demand"].cast("double").alias("avg_demand"),
        meta["best_mae"].cast("double").alias("best_mae"),
    )


@query
def model_state_roundtrip(spark, sf_dir):
    """The state table, written and read back."""
    path = scratch_path(spark, "states")
    tables.write_table(b.phases(spark, sf_dir).states(), path)
    return _states(spark.read.parquet(path))


@query
def boosted_model_roundtrip(spark, sf_dir):
    """Saved and loaded trees predict as the trained ones do."""
    p = b.phases(spark, sf_dir)
    path = scratch_path(spark, "boosted")
    p.booster().save(path)
    loaded = BoostedForecaster().load(path)
    return evaluate.forecast_summary(evaluate.prediction_rows(loaded.predict(p.test()), fv.BOOSTED_NAME, b.TIES))


@query
def gen_demand(spark, sf_dir):
    """Sample demand for the parts and regions of the test tables."""
    stores = b.table(spark, sf_dir, "region").agg(F.sort_array(F.collect_list("r_name"))).scalar()
    days = F.sequence(F.lit(0), F.lit(fv.SAMPLE_DAYS - 1))
    parts = b.table(spark, sf_dir, "part")
    # A few files of parts make many times as many rows, which a few tasks would draw.
    tasks = math.ceil(parts.count() * b.table(spark, sf_dir, "region").count() * fv.SAMPLE_DAYS / SAMPLE_ROWS)
    items = parts.select(
        F.concat(F.lit("ITEM_"), F.col("p_partkey")).alias("item_id"), F.col("p_type").alias("dept_id")
    )
    grid = items.repartition(max(1, tasks)).withColumn("store_id", F.explode(stores)).withColumn("k", F.explode(days))
    first = F.lit(fv.SAMPLE_START).cast("date")
    return sample.daily_demand(grid.withColumn("date", F.date_add(first, F.col("k"))).drop("k"))


@query
def gen_calendar(spark, sf_dir):
    """Calendar of all days from the first to the last ship date."""
    span = b.table(spark, sf_dir, "lineitem").agg(
        F.to_date(F.min("l_shipdate")).alias("d0"), F.to_date(F.max("l_shipdate")).alias("d1")
    )
    days = span.select("d0", F.explode(F.sequence("d0", "d1")).alias("date"))
    return sample.calendar_days(days, F.col("d0"))


# Projections and recoding


def _raw(spark, sf_dir, *dims):
    return b.raw_sales(spark, sf_dir, dims)


@query
def recode_default(spark, sf_dir):
    df = _raw(spark, sf_dir, "dept_id", "store_id")
    df = recode.recode(df, "dept_id", "demand_type", b.MAPS["dept_map"], F.lit(fv.DEFAULT_DEMAND_TYPE))
    df = recode.recode(df, "store_id", "region", b.MAPS["store_map"], F.lit(fv.DEFAULT_REGION))
    return df.groupBy("dept_id", "store_id", "demand_type", "region").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def recode_keep(spark, sf_dir):
    df = _raw(spark, sf_dir, "cat_id")
    df = recode.recode(df, "item_id", "part_number", b.MAPS["item_map"], F.col("item_id"))
    df = recode.recode(df, "cat_id", "part_description", b.MAPS["category_map"], F.col("cat_id"))
    return df.groupBy("part_number", "part_description").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def recode_null(spark, sf_dir):
    df = _raw(spark, sf_dir, "event_name_1")
    df = recode.recode(df, "event_name_1", "npi_signal", b.MAPS["event_map"])
    return df.groupBy("event_name_1", "npi_signal").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def conform(spark, sf_dir):
    return b.demand(spark, sf_dir).withColumn("unit_cost", r6("unit_cost"))


@query
def encode_categories(spark, sf_dir):
    df = features.category_codes(b.phases(spark, sf_dir).demand())
    return df.select(*b.KEY, "demand_type_encoded", "region_encoded", "has_npi_signal")


@query
def date_features(spark, sf_dir):
    return features.date_features(b.demand_series(spark, sf_dir)).drop("demand_quantity")


@query
def quality_flags(spark, sf_dir):
    return b.phases(spark, sf_dir).flagged().select(*b.KEY, "is_zero_demand", "is_demand_outlier", "has_npi_signal")


@query
def features_complete(spark, sf_dir):
    df = b.phases(spark, sf_dir).features()
    return df.select(*b.KEY, "demand_quantity", *_model_inputs(df))


def _model_inputs(df):
    doubles = {f.name for f in df.schema if f.dataType.typeName() == "double"}
    return [r6(c) if c in doubles else F.col(c) for c in fv.FEATURE_COLUMNS]


@query
def coerce_fields(spark, sf_dir):
    """Text and fractional fields cast to their types; quantities truncate."""
    df = b.phases(spark, sf_dir).dirty().withColumns(
        {
            "demand_quantity": F.col("demand_quantity") + F.lit(0.7),
            "unit_cost": F.format_string("%.2f", round_even(F.col("unit_cost"), 2)),
        }
    )
    done = validate.coerce_fields(df)
    return done.select(*b.DIRTY_KEY, "part_number", "demand_quantity", "unit_cost", "transaction_date", "npi_signal")


@query
def price_join(spark, sf_dir):
    sales = _raw(spark, sf_dir, "store_id")
    priced = recode.attach_prices(
        recode.recode(sales, "item_id", "item_id", b.MAPS["item_map"], F.col("item_id")),
        b.raw_prices(spark, sf_dir),
        b.MAPS["item_map"],
    )
    return priced.select("item_id", "store_id", "date", *b.TIES, r6("sell_price"))


@query
def price_join_weekly(spark, sf_dir):
    """Sales with a week key, priced by that week."""
    week = F.year("date") * 100 + F.weekofyear("date")
    sales = _raw(spark, sf_dir, "store_id").withColumn("wm_yr_wk", week)
    priced = recode.attach_weekly_prices(sales, b.raw_prices(spark, sf_dir))
    return priced.select("item_id", "store_id", "wm_yr_wk", *b.TIES, r6("sell_price"))


@query
def avg_price(spark, sf_dir):
    return recode.average_prices(b.raw_prices(spark, sf_dir)).select("item_id", "store_id", r6("sell_price"))


# Validation


@query
def validate_valid(spark, sf_dir):
    valid = validate.valid_rows(b.phases(spark, sf_dir).dirty()).drop("row_part", "row_date")
    return valid.withColumn("unit_cost", r6("unit_cost"))


@query
def validate_errors(spark, sf_dir):
    bad = validate.quarantine(b.phases(spark, sf_dir).dirty(), b.DIRTY_KEY)
    return bad.select(*b.DIRTY_KEY, F.size("errors").alias("n_errors"), "error")


@query
def validate_error_rows(spark, sf_dir):
    """Errors by row number in key order, as a batch reports them."""
    checked = validate.with_errors(b.phases(spark, sf_dir).dirty()).select(*b.DIRTY_KEY, "errors")
    rows = b.table(spark, sf_dir, "lineitem").count()
    numbered = number_rows(checked, list(b.DIRTY_KEY), rows=rows).filter(F.size("errors") > 0)
    return numbered.select("row", validate.error_text(F.col("errors")).alias("error"))


@query
def validate_open_errors(spark, sf_dir):
    """Records that bring fields of their own: some lack one, have one more, or lack the optional one."""
    checked = validate.with_open_errors(validate.open_records(b.open_dirty(spark, sf_dir)))
    bad = validate.quarantine(checked, b.DIRTY_KEY)
    return bad.select(*b.DIRTY_KEY, F.size("errors").alias("n_errors"), "error")


@query
def validate_open_valid(spark, sf_dir):
    checked = validate.with_open_errors(validate.open_records(b.open_dirty(spark, sf_dir)))
    return validate.valid_rows(checked).drop("row_part", "row_date").withColumn("unit_cost", r6("unit_cost"))


@query
def validation_report(spark, sf_dir):
    return validate.run_report(b.phases(spark, sf_dir).dirty(), list(fv.DEMAND_COLUMNS))


@query
def validation_report_skipped(spark, sf_dir):
    """Totals of a run without validation."""
    return validate.run_report(b.phases(spark, sf_dir).dirty(), list(fv.DEMAND_COLUMNS), validate=False)


@query
def validation_first_errors(spark, sf_dir):
    return validate.first_errors(validate.quarantine(b.phases(spark, sf_dir).dirty(), b.DIRTY_KEY), b.DIRTY_KEY)


# Aggregations


@query
def outlier_flag(spark, sf_dir):
    """The limit itself, and how many rows are beyond it."""
    df = b.demand_series(spark, sf_dir)
    limit = quality.outlier_limit(df)
    beyond = F.col("demand_quantity") > limit.scalar()
    counted = df.agg(F.count(F.when(beyond, 1)).alias("n_outliers"), F.count(F.lit(1)).alias("n_rows"))
    return counted.select("n_outliers", "n_rows", round_even(limit.scalar(), 6).alias("outlier_limit"))


@query
def dataset_summary(spark, sf_dir):
    flagged = b.phases(spark, sf_dir).flagged()
    return quality.dataset_summary(flagged.drop(*b.TIES))


@query
def demand_type_share(spark, sf_dir):
    return quality.value_share(b.phases(spark, sf_dir).demand(), "demand_type")


@query
def region_share(spark, sf_dir):
    return quality.value_share(b.phases(spark, sf_dir).demand(), "region")


@query
def model_metrics(spark, sf_dir):
    return b.phases(spark, sf_dir).metrics()


@query
def per_part_metrics(spark, sf_dir):
    return b.phases(spark, sf_dir).part_metrics()


@query
def model_improvement(spark, sf_dir):
    return evaluate.improvement(b.phases(spark, sf_dir).metrics())


@query
def best_model(spark, sf_dir):
    return evaluate.best_models(b.phases(spark, sf_dir).metrics())


@query
def part_profile(spark, sf_dir):
    return profile.part_statistics(b.phases(spark, sf_dir).features(), b.TIES)


@query
def demand_by_type(spark, sf_dir):
    return reports.demand_by_type(b.phases(spark, sf_dir).features())


@query
def forecast_summary(spark, sf_dir):
    return evaluate.forecast_summary(b.phases(spark, sf_dir).lead())


@query
def forecast_summary_part(spark, sf_dir):
    """The summary of one asked-for part."""
    return evaluate.forecast_summary(b.phases(spark, sf_dir).lead(), part="AMAT-RF-7800-GEN")


@query
def kpi_cards(spark, sf_dir):
    p = b.phases(spark, sf_dir)
    return reports.kpi_cards(p.chunks(), p.metrics())


@query
def split_summary(spark, sf_dir):
    p = b.phases(spark, sf_dir)
    return split.split_summary(p.features(), p.cut())


@query
def distinct_types(spark, sf_dir):
    return reports.distinct_types(b.phases(spark, sf_dir).chunks())


# Windows


@query
def lag_features(spark, sf_dir):
    return features.series_features(
        b.demand_series(spark, sf_dir), b.TIES, rolling=False, hot=b.phases(spark, sf_dir).hot()
    )


@query
def rolling_features(spark, sf_dir):
    df = features.series_features(b.demand_series(spark, sf_dir), b.TIES, hot=b.phases(spark, sf_dir).hot())
    names = ("rolling_mean_7", "rolling_mean_14", "rolling_std_7")
    return df.select(*b.KEY, *[r6(c) for c in names], "rolling_min_7", "rolling_max_7")


@query
def time_split(spark, sf_dir):
    p = b.phases(spark, sf_dir)
    return split.with_split(p.features(), p.cut()).select(*b.KEY, "split")


@query
def demand_trend(spark, sf_dir):
    return profile.demand_trend(b.phases(spark, sf_dir).features(), b.TIES)


@query
def naive_fallback(spark, sf_dir):
    """Previous row of the test set in time order; the first gets 0."""
    p = b.phases(spark, sf_dir)
    test = p.test().select(*b.KEY, "demand_quantity")
    order = ["transaction_date", "part_number", *b.TIES]
    zero = predict_previous_row(test, order, rows=p.cut().test_rows).withColumnRenamed("predicted", "naive")
    return zero.select(*b.KEY, "demand_quantity", "naive")


# Forecasts


def _states(df):
    return df.select(
        "part_number",
        "type",
        "n",
        r6("mean"),
        r6("level"),
        r6("trend"),
        F.array_join(F.transform("seasonal", lambda s: F.format_string("%.6f", round_even(s, 6))), ",").alias("seasonal"),
        F.array_join(F.transform("last_values", lambda v: v.cast("int").cast("string")), ",").alias("last_values"),
    )


@query
def fit_seasonal(spark, sf_dir):
    return _states(b.phases(spark, sf_dir).states())


@query
def forecast_seasonal(spark, sf_dir):
    return b.phases(spark, sf_dir).seasonal().select(*b.KEY, "demand_quantity", r6("predicted"))


def _yearly(rows):
    """Rows with a series per part and year: many short ones, and new ones among the test rows."""
    return rows.withColumn("part_number", F.concat_ws("|", "part_number", F.year("transaction_date")))


@query
def fit_seasonal_yearly(spark, sf_dir):
    return _states(fit_seasonal_states(_yearly(b.phases(spark, sf_dir).train()), b.TIES))


@query
def forecast_seasonal_yearly(spark, sf_dir):
    p = b.phases(spark, sf_dir)
    states = materialize(fit_seasonal_states(_yearly(p.train()), b.TIES), "yearly-states")
    return predict_seasonal(_yearly(p.test()), states).select(*b.KEY, "demand_quantity", r6("predicted"))


@query
def forecast_naive(spark, sf_dir):
    return predict_naive(b.phases(spark, sf_dir).test()).select(*b.KEY, "demand_quantity", "predicted")


@query
def forecast_gbt(spark, sf_dir):
    return b.phases(spark, sf_dir).boosted()


@query
def gbt_checked(spark, sf_dir):
    """Each prediction's key and actual, whether it is a number from 0 on, and equal after saving and loading."""
    p = b.phases(spark, sf_dir)
    path = scratch_path(spark, "boosted")
    p.booster().save(path)
    again = BoostedForecaster().load(path).predict(p.test()).select(*b.KEY, F.col("predicted").alias("loaded"))
    sound = (F.col("predicted") >= 0) & ~F.isnan("predicted") & (F.col("predicted") < float("inf"))
    rows = p.boosted().select(*b.KEY, "actual", "predicted").join(again, list(b.KEY))
    return rows.select(*b.KEY, "actual", F.coalesce(sound, F.lit(False)).alias("sound"), (F.col("predicted") == F.col("loaded")).alias("same_loaded"))


@query
def importance_checked(spark, sf_dir):
    """The features of the importances, whether they are shares, and add up to 1."""
    ranks = b.phases(spark, sf_dir).booster().importances(spark)
    total = F.round(F.sum("importance").over(Window.partitionBy(F.lit(0))), 6)
    return ranks.select("feature", F.col("importance").between(0, 1).alias("share"), total.alias("total"))


@query
def metrics_all_checked(spark, sf_dir):
    """All three models' rows; the figures of the two models that SQL can follow."""
    p = b.phases(spark, sf_dir)
    rows = evaluate.model_metrics(evaluate.stack([p.boosted(), p.predictions()]))
    known = F.col("model") != fv.BOOSTED_NAME
    figures = [F.when(known, F.col(c)).alias(c) for c in ("mae", "rmse", "mape")]
    better = F.max(F.when(~known, F.col("mae"))).over(Window.partitionBy(F.lit(0))) > 0
    return rows.select("model", *figures, better.alias("boosted_has_error"))


@query
def forecast_gbt_short(spark, sf_dir):
    """Two boosted trees in full: SQL finds the same splits and means."""
    rows = b.phases(spark, sf_dir).short_predictions().filter(F.col("model") == fv.BOOSTED_NAME)
    return rows.select(*b.KEY, "actual", r6("predicted"))


@query
def forecast_gbt_walked(spark, sf_dir):
    """The same predictions from the table of nodes: a join a level, all trees at once."""
    p = b.phases(spark, sf_dir)
    return trees.walk(p.test(), p.short_nodes(), 2, b.KEY).select(*b.KEY, r6("predicted"))


@query
def gbt_splits(spark, sf_dir):
    """The splits of the two trees: feature, threshold, rows trained on, share of the variance taken off."""
    nodes = b.phases(spark, sf_dir).short_nodes().filter("feature is not null")
    return nodes.select("tree", "feature", "threshold", F.col("n").cast("long").alias("n"), r6("gain"))


@query
def importance_short(spark, sf_dir):
    """Features of the two trees by what their splits take off the squares."""
    shares = trees.gain_shares(b.phases(spark, sf_dir).short_nodes(), b.SHORT).select("feature", r6("importance"))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("importance"), "feature"))
    return shares.select(place.alias("rank"), "feature", "importance")


@query
def model_metrics_short(spark, sf_dir):
    """All three models' rows with the boosted one's figures."""
    return evaluate.model_metrics(b.phases(spark, sf_dir).short_predictions())


@query
def stockout_risk_boosted(spark, sf_dir):
    """Profiles on the boosted model's errors by part."""
    columns = ("part_number", "trend", "trend_pct", "mae", "mape", "volatility", "stockout_risk", "risk_text", "advice")
    return b.phases(spark, sf_dir).short_profiles().select(*columns)


@query
def kb_chunks_boosted(spark, sf_dir):
    """All chunks of a knowledge base on the boosted model, the sentence of its features included."""
    return b.phases(spark, sf_dir).short_chunks().select("id", "text", "source", "metadata_json")


@query
def feature_importance(spark, sf_dir):
    return b.phases(spark, sf_dir).booster().top_importances(spark)


@query
def model_metrics_all(spark, sf_dir):
    """All three models on the one test set."""
    p = b.phases(spark, sf_dir)
    return evaluate.model_metrics(evaluate.stack([p.boosted(), p.predictions()]))


@query
def sample_predictions(spark, sf_dir):
    return evaluate.sample_predictions(b.phases(spark, sf_dir).lead(), ("transaction_date", "part_number", *b.TIES)).withColumn(
        "predicted", r6("predicted")
    )


@query
def forecast_chart(spark, sf_dir):
    """The first 50 test rows for the forecast chart."""
    order = ("transaction_date", "part_number", *b.TIES)
    rows = evaluate.sample_predictions(b.phases(spark, sf_dir).lead(), order, n=50)
    return rows.select("index", "actual", r6("predicted"))


# Profiles, knowledge base, retrieval


@query
def volatility_class(spark, sf_dir):
    return b.phases(spark, sf_dir).profiles().select("part_number", "avg_demand", "std_demand", "volatility")


@query
def stockout_risk(spark, sf_dir):
    columns = ("part_number", "trend", "trend_pct", "mape", "stockout_risk", "risk_text")
    return b.phases(spark, sf_dir).profiles().select(*columns)


@query
def stock_recommendation(spark, sf_dir):
    return b.phases(spark, sf_dir).profiles().select("part_number", "stockout_risk", "advice")


@query
def part_chunks(spark, sf_dir):
    chunks = narrate.part_chunks(b.phases(spark, sf_dir).profiles(), fv.SEASONAL_NAME)
    return chunks.select("id", "text", "metadata_json", "avg_demand")


@query
def model_summary_chunk(spark, sf_dir):
    chunk = narrate.summary_chunk(b.phases(spark, sf_dir).metrics())
    return chunk.select("id", "text", "metadata_json", "best_mae")


@query
def kb_all_chunks(spark, sf_dir):
    return b.phases(spark, sf_dir).chunks().select("id", "text", "source", "metadata_json")


@query
def kb_counts(spark, sf_dir):
    return narrate.chunk_counts(b.phases(spark, sf_dir).chunks())


@query
def query_terms(spark, sf_dir):
    """Search terms of every turn."""
    asked = b.table(spark, sf_dir, "conversations")
    terms = F.sort_array(retrieve.query_terms(F.col("text")))
    return asked.select("conv_id", "turn", "role", F.size(terms).alias("n_terms"), F.array_join(terms, " ").alias("terms"))


@query
def question_intent(spark, sf_dir):
    """Intent of every turn and every document."""
    turns = b.table(spark, sf_dir, "conversations").select(
        F.lit("turn").alias("kind"), F.col("conv_id").alias("a"), F.col("turn").alias("b"), "text"
    )
    docs = b.table(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("a"), F.lit(0).cast("long").alias("b"), "text"
    )
    return turns.unionByName(docs).select("kind", "a", "b", retrieve.question_intent(F.col("text")).alias("intent"))


@query
def kb_keyword_search(spark, sf_dir):
    hits = retrieve.keyword_search(b.phases(spark, sf_dir).chunks(), fv.SAMPLE_QUESTIONS)
    return hits.withColumn("score", r6("score"))


@query
def document_keyword_search(spark, sf_dir):
    """Whole documents as chunks; their language and source are the metadata."""
    docs = b.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        "text",
        F.concat(F.lit('{"lang": "'), F.col("lang"), F.lit('", "source": "'), F.col("source"), F.lit('"}')).alias(
            "metadata_json"
        ),
        F.array("lang", "source").alias("string_values"),
        F.lit(0).alias("kind"),
        F.col("doc_id").alias("seq"),
    )
    hits = retrieve.keyword_search(docs, DOCUMENT_QUESTIONS, top_k=10)
    return hits.withColumn("score", r6("score"))


DOCUMENT_QUESTIONS = (
    "What is the license of src1 code?",
    "Which en documents are about the email address",
    "of the and to",
    "le la que",
)


def label_centroids(spark, sf_dir) -> DataFrame:
    """Mean vector of each label: one aggregate, a sum per dimension."""
    rows = b.table(spark, sf_dir, "embeddings")
    dims = rows.agg(F.max(F.size("embedding"))).first()[0] or 0

    def mean(i: int):
        x = F.get("embedding", F.lit(i))
        return F.sum(x.cast("decimal(28,10)")).cast("double") / F.count(x)

    return rows.groupBy("label").agg(F.array(*[mean(i) for i in range(dims)]).alias("center")).orderBy("label")


@query
def vector_search(spark, sf_dir):
    """The vectors nearest to each label's mean, out of all vectors."""
    return _near(spark, sf_dir, None)


@query
def vector_search_filtered(spark, sf_dir):
    """The same within the vectors of one label."""
    return _near(spark, sf_dir, F.col("label") == 3)


def _near(spark, sf_dir, where):
    # A request of one query vector per label, as a caller would send it.
    centers = [r["center"] for r in label_centroids(spark, sf_dir).toLocalIterator()]
    rows = b.table(spark, sf_dir, "embeddings")
    hits = retrieve.vector_search(rows, centers, top_k=3, key="vec_id", where=where)
    return hits.select("qid", "rank", "vec_id", r6("distance"))


def _embedded(spark, sf_dir):
    chunks = b.phases(spark, sf_dir).chunks()
    embedder = embedding.text_embedder(chunks)
    return embedder, embedding.embed(chunks, embedder)


def _checked(embedded: DataFrame, key: str) -> DataFrame:
    """Terms of every vector, its squared length, and a sum that depends on each term's number and weight."""
    squares = F.aggregate("embedding", F.lit(0.0), lambda t, p: t + p["weight"] * p["weight"])
    marked = F.aggregate("embedding", F.lit(0.0), lambda t, p: t + p["weight"] * (p["term"] % 1009 + 1))
    sums = embedded.select(key, F.size("embedding").alias("size"), squares.alias("norm"), marked.alias("checksum"))
    return sums.select(key, "size", r6("norm"), r6("checksum"))


@query
def embed_chunks(spark, sf_dir):
    return _checked(_embedded(spark, sf_dir)[1], "id")


@query
def embed_documents(spark, sf_dir):
    """Embedding of whole documents over the dictionary of all their terms."""
    docs = b.table(spark, sf_dir, "documents").select("doc_id", "text")
    return _checked(embedding.embed(docs, embedding.text_embedder(docs), "doc_id"), "doc_id")


@query
def answer_batch(spark, sf_dir):
    answers = b.phases(spark, sf_dir).answers()
    return answers.select("qid", "question", "answer", F.array_join("sources", ",").alias("sources"), "num_sources")


@query
def answer_user_turns(spark, sf_dir):
    """A table of questions: what users asked in all conversations."""
    asked = b.table(spark, sf_dir, "conversations").filter(F.col("role") == "user").select("conv_id", "turn", "text")
    answers = answer_table(b.phases(spark, sf_dir).chunks(), asked, "text")
    return answers.select("conv_id", "turn", "answer", F.array_join("sources", ",").alias("sources"), "num_sources")


@query
def answer_batch_vector(spark, sf_dir):
    embedder, embedded = _embedded(spark, sf_dir)
    embedded = materialize(embedded, "embedded-chunks")
    answers = answer_by_vectors(embedded, fv.SAMPLE_QUESTIONS, embedder)
    return answers.select("qid", "question", "answer", F.array_join("sources", ",").alias("sources"), "num_sources")


@query
def rag_context(spark, sf_dir):
    return context_and_prompt(b.phases(spark, sf_dir).chunks(), fv.SAMPLE_QUESTIONS).select("qid", "context")


@query
def rag_prompt(spark, sf_dir):
    return context_and_prompt(b.phases(spark, sf_dir).chunks(), fv.SAMPLE_QUESTIONS).select("qid", "prompt")


@query
def list_parts(spark, sf_dir):
    return reports.list_parts(b.phases(spark, sf_dir).chunks())


@query
def list_parts_of_type(spark, sf_dir):
    """Parts of one picked demand type."""
    return reports.list_parts(b.phases(spark, sf_dir).chunks(), "NPI")


@query
def risk_listing(spark, sf_dir):
    return reports.risk_listing(b.phases(spark, sf_dir).chunks())


@query
def risk_buckets(spark, sf_dir):
    return reports.risk_buckets(b.phases(spark, sf_dir).chunks())
