"""The test tables seen as the raw tables of the demand analytics.

Line items are the sales, their ship date is the day, the supplier's region is
the store. Foreign keys have no orphans, so a view only joins the tables whose
columns it is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.operators.answers import answer_questions
from partflow.operators.evaluate import model_metrics, part_metrics, prediction_rows, stack
from partflow import fixed_values as fv
from partflow.operators.features import build_features
from partflow.operators.models.boosted import BoostedForecaster
from partflow.operators.models.naive import predict_naive
from partflow.operators.models.seasonal import fit_seasonal, predict_seasonal
from partflow.operators.models.trees import gain_shares, node_table
from partflow.operators.narrate import assemble, domain_chunks, part_chunks, summary_chunk
from partflow.operators.ordering import hot_keys
from partflow.operators.profile import part_profiles
from partflow.operators.quality import quality_flags
from partflow.operators.recode import conform, recode, rename_and_project
from partflow.operators.split import find_cut, fit_rows, holdout_rows
from partflow.plans.forecast import split_order
from partflow.session import broadcast_within, materialize, scratch_path

TIES = ("order_key", "line_number")
KEY = ("part_number", "transaction_date", *TIES)

#: Features of the short boosted model.
SHORT = ("day_of_week", "day_of_month", "month", "demand_type_encoded", "region_encoded")

# Dictionaries for the test tables; some keys are left out to exercise misses.
MAPS = {
    "dept_map": {
        "SMALL": "NPI",
        "STANDARD": "standard",
        "ECONOMY": "standard",
        "PROMO": "service_campaign",
        "MEDIUM": "reliability",
    },
    "store_map": {
        "AMERICA": "North America",
        "ASIA": "Asia Pacific",
        "MIDDLE EAST": "Asia Pacific",
        "EUROPE": "Europe",
    },
    "item_map": {f"ITEM_{i}": name for i, name in enumerate(fv.ITEM_TO_PART_NUMBER.values())},
    "category_map": {
        "ring": "RF & Lithography Components",
        "bolt": "CVD Gas Delivery Systems",
        "gear": "CMP & Etch Consumables",
    },
    "event_map": {
        "1-URGENT": "AMAT_TechNode_3nm_Launch",
        "2-HIGH": "AMAT_Producer_SE_Release",
    },
}
#: Every so manieth part is priced under a former name, so its sales find no price.
FORMER_NAME_EVERY = 11


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_sales(
    spark: SparkSession,
    sf_dir: str,
    dims: tuple[str, ...] = ("dept_id", "cat_id", "store_id", "event_name_1"),
) -> DataFrame:
    """Sales rows with the asked-for dimension columns.

    Some orders sold nothing and some a multiple, so that the flags, masks and
    limits of the demand operators have something to find; all rows stay.
    """
    quantity = F.col("l_quantity")
    sold = F.when(F.col("l_orderkey") % 61 == 0, 0).when(F.col("l_orderkey") % 59 == 0, quantity * 40).otherwise(quantity)
    # Only keys and numbers go through the joins, each once.
    df = table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        "l_orderkey",
        "l_suppkey",
        F.to_date("l_shipdate").alias("date"),
        sold.cast("int").alias("sales"),
        "l_linenumber",
    )
    if "event_name_1" in dims:
        orders = table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("event_name_1")
        )
        df = df.join(orders, "l_orderkey")
    if "dept_id" in dims or "cat_id" in dims:
        parts = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("l_partkey"),
            F.col("p_type").alias("dept_id"),
            F.split("p_name", " ")[1].alias("cat_id"),
        )
        df = df.join(parts, "l_partkey")
    if "store_id" in dims:
        df = df.join(supplier_stores(spark, sf_dir), "l_suppkey")
    item = F.concat(F.lit("ITEM_"), F.col("l_partkey")).alias("item_id")
    ties = F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_number")
    return df.select(item, *dims, "date", "sales", *ties)


def supplier_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier to region name. 25 nations and 5 regions, at every scale.

    Suppliers grow with the data: they are broadcast up to a counted limit.
    """
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    regions = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("store_id"))
    stores = nations.join(F.broadcast(regions), nations["n_regionkey"] == regions["r_regionkey"])
    scan = table(spark, sf_dir, "supplier")
    suppliers = scan.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    joined = suppliers.join(F.broadcast(stores), suppliers["s_nationkey"] == stores["n_nationkey"])
    return broadcast_within(joined.select("l_suppkey", "store_id"), scan)


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit prices by item, store and week; some items are listed under a former name."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", F.to_date("l_shipdate").alias("d")
    )
    priced = lines.join(supplier_stores(spark, sf_dir), "l_suppkey")
    former = F.when(F.col("l_partkey") % FORMER_NAME_EVERY == 0, F.lit("_OLD")).otherwise(F.lit(""))
    return priced.select(
        "store_id",
        F.concat(F.lit("ITEM_"), F.col("l_partkey"), former).alias("item_id"),
        (F.year("d") * 100 + F.weekofyear("d")).alias("wm_yr_wk"),
        (F.rint(F.col("l_extendedprice") / F.col("l_quantity") * 100) / 100).alias("sell_price"),
    )


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand records with their key columns."""
    return conform(raw_sales(spark, sf_dir), raw_prices(spark, sf_dir), TIES, **MAPS)


def open_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty records as JSON texts with fields of their own, next to their keys."""
    df = phases(spark, sf_dir).dirty()
    every = {n: F.col("order_key") % n == 0 for n in (31, 37, 41, 29)}

    def text(*names, **more) -> Column:
        return F.to_json(F.struct(*names, *[v.alias(n) for n, v in more.items()]), {"ignoreNullFields": "false"})

    def but(*left_out: str) -> list[str]:
        return [c for c in fv.DEMAND_COLUMNS if c not in left_out]

    record = (
        F.when(every[41], text(*but("unit_cost", "region")))
        .when(every[37], text(*but("part_number"), warehouse=F.lit("W1"), batch=F.col("line_number")))
        .when(every[31], text(*but("npi_signal")))
        .when(every[29], F.substring(text(*but()), 1, 40))
        .otherwise(text(*but()))
    )
    return df.select(*DIRTY_KEY, record.alias("record"))


def demand_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only what the series operators need: part, date, ties, quantity."""
    sales = raw_sales(spark, sf_dir, dims=())
    return rename_and_project(recode(sales, "item_id", "item_id", MAPS["item_map"], F.col("item_id")), TIES)


def with_defects(records: DataFrame) -> DataFrame:
    """Demand records with defects planted by order key; all rows stay.

    The date is text, as records come in. Rules stack, so a row may carry
    several defects.
    """

    def hit(k: int):
        return F.col("order_key") % k == 0

    q = F.when(hit(61), F.lit(0)).otherwise(F.col("demand_quantity"))
    df = records.withColumn("row_date", F.col("transaction_date"))
    return df.withColumns(
        {
            "row_part": F.col("part_number"),
            "demand_quantity": F.when(hit(43), F.lit(None)).when(hit(97), -q).otherwise(q),
            "region": F.when(hit(89), F.lit("Atlantis")).otherwise(F.col("region")),
            "transaction_date": F.when(hit(83), F.lit("2015-13-45")).otherwise(
                F.col("transaction_date").cast("string")
            ),
            "unit_cost": F.when(hit(79), F.lit(0.0))
            .when(hit(53), F.lit(None))
            .when(hit(47), F.lit(float("nan")))
            .otherwise(F.col("unit_cost")),
            "part_number": F.when(hit(73), F.lit("  ")).otherwise(F.col("part_number")),
            "demand_type": F.when(hit(71), F.lit("unknown")).otherwise(F.col("demand_type")),
            "part_description": F.when(hit(67), F.lit("")).otherwise(F.col("part_description")),
        }
    )


DIRTY_KEY = ("row_part", "row_date", *TIES)


def hot_parts(spark: SparkSession, sf_dir: str) -> DataFrame | None:
    """Parts too large for one task, counted on the part key column alone."""
    keys = table(spark, sf_dir, "lineitem").select("l_partkey")
    hot = hot_keys(keys, ["l_partkey"])
    if hot is None:
        return None
    item = F.concat(F.lit("ITEM_"), F.col("l_partkey"))
    lookup = F.create_map(*[F.lit(x) for pair in MAPS["item_map"].items() for x in pair])
    return hot.select(F.coalesce(lookup[item], item).alias("part_number"), "_rows")


class Phases:
    """The phases of one test folder, each run once and left as a table.

    A phase reads the table of the phase before it, as separate jobs would.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._done: dict[str, object] = {}

    def _once(self, name: str, make):
        if name not in self._done:
            self._done[name] = make()
        return self._done[name]

    def demand(self) -> DataFrame:
        return self._once("demand", lambda: materialize(demand(self.spark, self.sf_dir), "demand"))

    def flagged(self) -> DataFrame:
        return quality_flags(self.demand())

    def dirty(self) -> DataFrame:
        return with_defects(self.demand())

    def hot(self):
        return self._once("hot", lambda: hot_parts(self.spark, self.sf_dir))

    def features(self) -> DataFrame:
        return self._once(
            "features", lambda: materialize(build_features(self.demand(), TIES, hot=self.hot()), "features")
        )

    def cut(self):
        return self._once("cut", lambda: find_cut(self.features(), split_order(TIES)))

    def train(self) -> DataFrame:
        return fit_rows(self.features(), self.cut())

    def test(self) -> DataFrame:
        return holdout_rows(self.features(), self.cut())

    def states(self) -> DataFrame:
        return self._once(
            "states", lambda: materialize(fit_seasonal(self.train(), TIES), "seasonal-states")
        )

    def seasonal(self) -> DataFrame:
        return predict_seasonal(self.test(), self.states())

    def predictions(self) -> DataFrame:
        """Seasonal and naive predictions, keyed."""

        def make():
            frames = [
                prediction_rows(self.seasonal(), fv.SEASONAL_NAME, TIES),
                prediction_rows(predict_naive(self.test()), fv.NAIVE_NAME, TIES),
            ]
            return materialize(stack(frames), "predictions")

        return self._once("predictions", make)

    def lead(self) -> DataFrame:
        """Predictions of the model that profiles are built on."""
        return self.predictions().filter(F.col("model") == fv.SEASONAL_NAME)

    def metrics(self) -> DataFrame:
        return model_metrics(self.predictions())

    def part_metrics(self) -> DataFrame:
        return part_metrics(self.lead(), ("transaction_date", *TIES))

    def profiles(self) -> DataFrame:
        return part_profiles(self.features(), self.part_metrics(), TIES)

    def chunks(self) -> DataFrame:
        def make():
            parts = part_chunks(self.profiles(), fv.SEASONAL_NAME)
            return materialize(assemble(parts, summary_chunk(self.metrics()), domain_chunks(self.spark)), "chunks")

        return self._once("chunks", make)

    def booster(self) -> BoostedForecaster:
        return self._once("booster", lambda: BoostedForecaster().train(self.train()))

    def boosted(self) -> DataFrame:
        return prediction_rows(self.booster().predict(self.test()), fv.BOOSTED_NAME, TIES)

    def short_booster(self) -> BoostedForecaster:
        """Two trees that SQL can derive: few values a feature, no two features that split alike, all rows."""
        return self._once(
            "short-booster", lambda: BoostedForecaster(trees=2, depth=2, row_share=1.0, features=SHORT).train(self.train())
        )

    def short_nodes(self) -> DataFrame:
        """The node table of the saved short model."""

        def make():
            path = scratch_path(self.spark, "short-booster")
            self.short_booster().save(path)
            return materialize(node_table(self.spark, path), "short-nodes")

        return self._once("short-nodes", make)

    def short_predictions(self) -> DataFrame:
        """All three models, the boosted one being the short one."""

        def make():
            rows = prediction_rows(self.short_booster().predict(self.test()), fv.BOOSTED_NAME, TIES)
            return materialize(stack([rows, self.predictions()]), "short-predictions")

        return self._once("short-predictions", make)

    def short_profiles(self) -> DataFrame:
        lead = self.short_predictions().filter(F.col("model") == fv.BOOSTED_NAME)
        return part_profiles(self.features(), part_metrics(lead, ("transaction_date", *TIES)), TIES)

    def short_chunks(self) -> DataFrame:
        summary = summary_chunk(model_metrics(self.short_predictions()), importances=gain_shares(self.short_nodes(), SHORT))
        return assemble(part_chunks(self.short_profiles(), fv.BOOSTED_NAME), summary, domain_chunks(self.spark))

    def answers(self, top_k: int = fv.TOP_K_DEFAULT) -> DataFrame:
        return answer_questions(self.chunks(), fv.SAMPLE_QUESTIONS, top_k)


_phases: dict[tuple[str, str], Phases] = {}


def phases(spark: SparkSession, sf_dir: str) -> Phases:
    """The phases of a folder within the running application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _phases:
        _phases[key] = Phases(spark, sf_dir)
    return _phases[key]
