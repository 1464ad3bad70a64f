"""DuckDB SQL for the registered queries, written over the raw test tables.

Every statement starts from the tables and repeats the definition of what the
query computes; the fragments below are common table expressions.
"""

from __future__ import annotations

from harness.binding import MAPS, SHORT
from harness.catalog import DOCUMENT_QUESTIONS
from partflow import fixed_values as fv
from partflow.functions.text import SPACE_CODES

ORACLE: dict[str, str] = {}


def q(text) -> str:
    return "'" + str(text).replace("'", "''") + "'"


def rd(x: str, n: int) -> str:
    """Round half to even on the scaled double."""
    return f"(round_even(({x})::DOUBLE * 1e{n}::DOUBLE, 0) / 1e{n}::DOUBLE)"


def mean(x: str) -> str:
    """Mean of doubles taken at 8 decimals, free of summation order."""
    return f"(sum({rd(x, 8)}::DECIMAL(28,10))::DOUBLE / count({x}))"


def case(column: str, mapping: dict, miss: str) -> str:
    arms = " ".join(f"WHEN {q(k)} THEN {v if isinstance(v, int) else q(v)}" for k, v in mapping.items())
    return f"CASE {column} {arms} ELSE {miss} END"


def short(x: str, n: int) -> str:
    return f"regexp_replace(printf('%.{n}f', {x}), '(\\.\\d+?)0+$', '\\1')"


def values(column: str) -> str:
    return ", ".join(q(v) for v in column)


def put(name: str, sql: str) -> None:
    ORACLE[name] = sql


# Raw tables

# Some orders sold nothing, some a multiple.
SOLD = "(CASE WHEN l_orderkey % 61 = 0 THEN 0 WHEN l_orderkey % 59 = 0 THEN l_quantity * 40 ELSE l_quantity END)::INT"

RAW = f"""
raw AS (
  SELECT 'ITEM_' || l_partkey AS item_id, p_type AS dept_id, split_part(p_name, ' ', 2) AS cat_id,
         r_name AS store_id, o_orderpriority AS event_name_1, l_shipdate::DATE AS date,
         {SOLD} AS sales, l_orderkey AS order_key, l_linenumber AS line_number
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
  JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
  JOIN region ON r_regionkey = n_regionkey
),
prices AS (
  SELECT r_name AS store_id, 'ITEM_' || l_partkey || CASE WHEN l_partkey % 11 = 0 THEN '_OLD' ELSE '' END AS item_id,
         (year(l_shipdate) * 100 + week(l_shipdate))::INT AS wm_yr_wk,
         {rd('l_extendedprice / l_quantity', 2)} AS sell_price
  FROM lineitem
  JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
  JOIN region ON r_regionkey = n_regionkey
),
averages AS (SELECT item_id, store_id, {mean('sell_price')} AS sell_price FROM prices GROUP BY ALL)"""

PART_OF = case("item_id", MAPS["item_map"], "item_id")
TYPE_OF = case("dept_id", MAPS["dept_map"], q(fv.DEFAULT_DEMAND_TYPE))
REGION_OF = case("store_id", MAPS["store_map"], q(fv.DEFAULT_REGION))
CATEGORY_OF = case("cat_id", MAPS["category_map"], "cat_id")
SIGNAL_OF = case("event_name_1", MAPS["event_map"], "NULL")

# The price of an item is looked up under its final name, as for the sales.
DEMAND = (
    RAW
    + f""",
named_prices AS (SELECT {PART_OF} AS item_id, store_id, sell_price FROM averages),
demand AS (
  SELECT s.part AS part_number, s.demand_type, s.region, s.sales AS demand_quantity, s.date AS transaction_date,
         coalesce(p.sell_price, {fv.DEFAULT_UNIT_COST})::DOUBLE AS unit_cost, s.description AS part_description,
         s.signal AS npi_signal, s.order_key, s.line_number
  FROM (SELECT *, {PART_OF} AS part, {TYPE_OF} AS demand_type, {REGION_OF} AS region,
               {CATEGORY_OF} AS description, {SIGNAL_OF} AS signal FROM raw) s
  LEFT JOIN named_prices p ON p.item_id = s.part AND p.store_id = s.store_id
)"""
)
SERIES = f"""
demand AS (
  SELECT part AS part_number, {SOLD} AS demand_quantity, l_shipdate::DATE AS transaction_date,
         l_orderkey AS order_key, l_linenumber AS line_number
  FROM (SELECT *, {PART_OF} AS part FROM (SELECT *, 'ITEM_' || l_partkey AS item_id FROM lineitem))
)"""

KEY = "part_number, transaction_date, order_key, line_number"

put(
    "scan_csv_roundtrip",
    f"""WITH {RAW} SELECT store_id, event_name_1, count(*) AS n_rows, sum(sales)::BIGINT AS total_sales,
    strftime(min(date), '%Y-%m-%d') AS first_date, strftime(max(date), '%Y-%m-%d') AS last_date
    FROM raw GROUP BY ALL""",
)
put(
    "scan_parquet_dates",
    f"""WITH {SERIES} SELECT year(transaction_date)::INT AS year, count(*) AS n_rows,
    min(transaction_date) AS first_date, max(transaction_date) AS last_date FROM demand GROUP BY 1""",
)
put(
    "sink_partitioned",
    f"""WITH {DEMAND} SELECT demand_type, count(*) AS n_rows, sum(demand_quantity)::BIGINT AS total_demand
    FROM demand GROUP BY 1""",
)
put(
    "gen_calendar",
    f"""SELECT d::DATE AS date, ((d::DATE - d0) // 7 + {fv.FIRST_WEEK})::INT AS wm_yr_wk, dayname(d) AS weekday,
    isodow(d)::INT AS wday, month(d)::INT AS month, year(d)::INT AS year,
    {", ".join(f"((d::DATE - d0) % 7 < {n})::INT AS {name}" for name, n in fv.SNAP_DAYS.items())}
    FROM (SELECT d0, unnest(generate_series(d0::TIMESTAMP, d1::TIMESTAMP, INTERVAL 1 DAY)) AS d
          FROM (SELECT min(l_shipdate)::DATE AS d0, max(l_shipdate)::DATE AS d1 FROM lineitem))""",
)



def drawn(seed: int, *keys: str) -> str:
    text = " || '|' || ".join([q(seed), *[f"({k})::VARCHAR" for k in keys]])
    return f"(('0x' || substr(md5({text}), 1, 12))::BIGINT / {float(1 << 48)}::DOUBLE)"


# Sums of the Poisson probabilities of each mean, up to where they reach 1.
MEANS = ", ".join(f"({float(m)}::DOUBLE)" for m in sorted({fv.SAMPLE_MEAN_OTHER, *(m for _, m in fv.SAMPLE_MEANS)}))
STEPS = f"""terms(mean, i, p, total) AS (
      SELECT m, 0, exp(-m), exp(-m) FROM (VALUES {MEANS}) AS v(m)
      UNION ALL SELECT mean, i + 1, p * (mean / (i + 1)), total + p * (mean / (i + 1)) FROM terms
      WHERE total < 1 - 1e-12::DOUBLE AND i + 1 < 20 * mean + 50),
    steps AS (SELECT mean, list(least(total, 1.0::DOUBLE) ORDER BY i) AS sums FROM terms GROUP BY mean)"""
MEAN_OF = "CASE " + " ".join(f"WHEN starts_with(dept_id, {q(d)}) THEN {float(m)}" for d, m in fv.SAMPLE_MEANS)
MEAN_OF = f"({MEAN_OF} ELSE {float(fv.SAMPLE_MEAN_OTHER)} END)::DOUBLE"
EVENTS = "[" + ", ".join("NULL" if e is None else q(e) for e in fv.SAMPLE_EVENTS) + "]"
put(
    "gen_demand",
    f"""WITH RECURSIVE {STEPS}, grid AS (SELECT 'ITEM_' || p_partkey AS item_id, p_type AS dept_id, r_name AS store_id,
      (DATE {q(fv.SAMPLE_START)} + k::INT)::DATE AS date FROM part, region, range({fv.SAMPLE_DAYS}) AS d(k)),
    luck AS (SELECT *, {drawn(42, 'item_id', 'store_id', 'date')} AS u, {drawn(43, 'item_id', 'store_id', 'date')} AS v FROM grid),
    base AS (SELECT luck.*, len(list_filter(sums, lambda s: s <= u)) AS b FROM luck JOIN steps ON mean = {MEAN_OF})
    SELECT item_id, dept_id, store_id, date,
      CASE WHEN isodow(date) >= 6 THEN floor(b * {fv.SAMPLE_WEEKEND_LIFT}::DOUBLE)::INT ELSE b::INT END AS sales,
      {EVENTS}[floor(v * {len(fv.SAMPLE_EVENTS)})::INT + 1] AS event_name_1 FROM base""",
)

# Recoding

put(
    "recode_default",
    f"""WITH {RAW} SELECT dept_id, store_id, {TYPE_OF} AS demand_type, {REGION_OF} AS region, count(*) AS n_rows
    FROM raw GROUP BY ALL""",
)
put(
    "recode_keep",
    f"""WITH {RAW} SELECT {PART_OF} AS part_number, {CATEGORY_OF} AS part_description, count(*) AS n_rows
    FROM raw GROUP BY ALL""",
)
put(
    "recode_null",
    f"WITH {RAW} SELECT event_name_1, {SIGNAL_OF} AS npi_signal, count(*) AS n_rows FROM raw GROUP BY ALL",
)
put("conform", f"WITH {DEMAND} SELECT * REPLACE ({rd('unit_cost', 6)} AS unit_cost) FROM demand")
TYPE_CODE = case("demand_type", fv.DEMAND_TYPE_CODES, str(fv.UNKNOWN_CODE))
REGION_CODE = case("region", fv.REGION_CODES, str(fv.UNKNOWN_CODE))
put(
    "encode_categories",
    f"""WITH {DEMAND} SELECT {KEY}, {TYPE_CODE} AS demand_type_encoded, {REGION_CODE} AS region_encoded,
    (npi_signal IS NOT NULL)::INT AS has_npi_signal FROM demand""",
)
DATE_PARTS = """(isodow(transaction_date) - 1)::INT AS day_of_week, day(transaction_date)::INT AS day_of_month,
    week(transaction_date)::INT AS week_of_year, month(transaction_date)::INT AS month,
    quarter(transaction_date)::INT AS quarter, (isodow(transaction_date) >= 6)::INT AS is_weekend,
    (day(transaction_date) = 1)::INT AS is_month_start,
    (last_day(transaction_date) = transaction_date)::INT AS is_month_end"""
put("date_features", f"WITH {SERIES} SELECT {KEY}, {DATE_PARTS} FROM demand")

FLAGGED = (
    DEMAND
    + """,
spread AS (SELECT count(*) AS n, avg(demand_quantity) AS m, stddev_samp(demand_quantity) AS s FROM demand),
flagged AS (
  SELECT demand.*, (demand_quantity = 0)::INT AS is_zero_demand,
         (CASE WHEN n > 1 AND s > 0 AND demand_quantity > m + 3 * s THEN 1 ELSE 0 END)::INT AS is_demand_outlier,
         (npi_signal IS NOT NULL)::INT AS has_npi_signal
  FROM demand, spread
)"""
)
put("quality_flags", f"WITH {FLAGGED} SELECT {KEY}, is_zero_demand, is_demand_outlier, has_npi_signal FROM flagged")
put(
    "avg_price",
    f"WITH {RAW} SELECT item_id, store_id, {rd('sell_price', 6)} AS sell_price FROM averages",
)
put(
    "price_join",
    f"""WITH {RAW}, named AS (SELECT {PART_OF} AS item_id, store_id, sell_price FROM averages),
    sold AS (SELECT {PART_OF} AS item_id, store_id, date, order_key, line_number FROM raw)
    SELECT item_id, store_id, date, order_key, line_number, {rd(f'coalesce(sell_price, {fv.DEFAULT_UNIT_COST})', 6)} AS sell_price
    FROM sold LEFT JOIN named USING (item_id, store_id)""",
)
put(
    "price_join_weekly",
    f"""WITH {RAW}, sold AS (SELECT *, (year(date) * 100 + week(date))::INT AS wm_yr_wk FROM raw),
    weekly AS (SELECT item_id, store_id, wm_yr_wk, {mean('sell_price')} AS sell_price FROM prices GROUP BY ALL)
    SELECT item_id, store_id, wm_yr_wk, order_key, line_number,
           {rd(f'coalesce(sell_price, {fv.DEFAULT_UNIT_COST})', 6)} AS sell_price
    FROM sold LEFT JOIN weekly USING (item_id, store_id, wm_yr_wk)""",
)

# Validation

DIRTY_KEY = "row_part, row_date, order_key, line_number"
DIRTY = (
    DEMAND
    + """,
dirty AS (
  SELECT CASE WHEN order_key % 73 = 0 THEN '  ' ELSE part_number END AS part_number,
         CASE WHEN order_key % 71 = 0 THEN 'unknown' ELSE demand_type END AS demand_type,
         CASE WHEN order_key % 89 = 0 THEN 'Atlantis' ELSE region END AS region,
         (CASE WHEN order_key % 43 = 0 THEN NULL WHEN order_key % 61 = 0 THEN 0 ELSE demand_quantity END
          * CASE WHEN order_key % 97 = 0 THEN -1 ELSE 1 END)::INT AS demand_quantity,
         CASE WHEN order_key % 83 = 0 THEN '2015-13-45' ELSE strftime(transaction_date, '%Y-%m-%d') END AS transaction_date,
         CASE WHEN order_key % 79 = 0 THEN 0.0::DOUBLE WHEN order_key % 53 = 0 THEN NULL
              WHEN order_key % 47 = 0 THEN 'NaN'::DOUBLE ELSE unit_cost END AS unit_cost,
         CASE WHEN order_key % 67 = 0 THEN '' ELSE part_description END AS part_description,
         npi_signal, order_key, line_number, part_number AS row_part, transaction_date AS row_date
  FROM demand
)"""
)
M = fv.CHECK_MESSAGES


def message(name: str, shown: str = "") -> str:
    head, _, tail = M[name].partition("%s")
    return f"{q(head)} || {shown} || {q(tail)}" if shown else q(M[name])


CHECKED = (
    DIRTY
    + f""",
checked AS (
  SELECT *, list_filter([
    CASE WHEN trim(part_number) = '' THEN {message('part_number')} END,
    CASE WHEN demand_type NOT IN ({values(fv.DEMAND_TYPES)}) THEN {message('demand_type', 'demand_type')} END,
    CASE WHEN region NOT IN ({values(fv.REGIONS)}) THEN {message('region', 'region')} END,
    CASE WHEN demand_quantity IS NULL THEN {message('quantity_type')} END,
    CASE WHEN demand_quantity < 0 THEN {message('quantity_sign', 'demand_quantity::VARCHAR')} END,
    CASE WHEN unit_cost IS NULL OR isnan(unit_cost) THEN {message('cost_type')} END,
    CASE WHEN unit_cost <= 0 THEN {message('cost_sign', 'unit_cost::VARCHAR')} END,
    CASE WHEN try_strptime(transaction_date, '%Y-%m-%d') IS NULL THEN {message('date', 'transaction_date')} END,
    CASE WHEN trim(part_description) = '' THEN {message('part_description')} END
  ], lambda m: m IS NOT NULL) AS errors
  FROM dirty
)"""
)
ERROR = (
    f"{q(fv.CHECK_HEADER)} || chr(10) || array_to_string(list_transform(errors, lambda m: '  - ' || m), chr(10))"
)
put(
    "validate_valid",
    f"""WITH {CHECKED} SELECT part_number, demand_type, region, demand_quantity, transaction_date::DATE AS transaction_date,
    {rd('unit_cost', 6)} AS unit_cost, part_description, npi_signal, order_key, line_number
    FROM checked WHERE len(errors) = 0""",
)
put(
    "validate_errors",
    f"""WITH {CHECKED} SELECT {DIRTY_KEY}, len(errors)::INT AS n_errors, {ERROR} AS error
    FROM checked WHERE len(errors) > 0""",
)
put(
    "validate_error_rows",
    f"""WITH {CHECKED}, numbered AS (SELECT *, row_number() OVER (ORDER BY {DIRTY_KEY}) - 1 AS row FROM checked)
    SELECT row, {ERROR} AS error FROM numbered WHERE len(errors) > 0""",
)
OPEN = CHECKED.replace("checked AS (", "looked AS (") + f""",
checked AS (
  SELECT * REPLACE (CASE
    WHEN order_key % 41 = 0 THEN [{message('missing_field', q('region'))}, {message('missing_field', q('unit_cost'))}]
    WHEN order_key % 37 = 0 THEN [{message('unknown_field', q('batch'))}, {message('unknown_field', q('warehouse'))},
                                  {message('missing_field', q('part_number'))}]
    WHEN order_key % 31 = 0 THEN errors
    WHEN order_key % 29 = 0 THEN [{message('no_record')}] ELSE errors END AS errors,
    CASE WHEN order_key % 31 = 0 THEN NULL ELSE npi_signal END AS npi_signal)
  FROM looked
)"""
put("validate_open_errors", ORACLE["validate_errors"].replace(CHECKED, OPEN))
put("validate_open_valid", ORACLE["validate_valid"].replace(CHECKED, OPEN))
NULLS = " + ".join(f"({c} IS NULL)::INT" for c in fv.DEMAND_COLUMNS)
put(
    "validation_report",
    f"""WITH {CHECKED} SELECT count(*) AS total_records, sum((len(errors) = 0)::INT)::BIGINT AS valid_records,
    sum((len(errors) > 0)::INT)::BIGINT AS rejected_records,
    {rd('sum((len(errors) = 0)::INT) / count(*) * 100', 1)} AS pass_rate, sum({NULLS})::BIGINT AS null_values FROM checked""",
)
put(
    "validation_report_skipped",
    f"""WITH {DIRTY} SELECT count(*) AS total_records, count(*) AS valid_records, 0::BIGINT AS rejected_records,
    100.0::DOUBLE AS pass_rate, sum({NULLS})::BIGINT AS null_values FROM dirty""",
)
put(
    "validation_first_errors",
    f"""WITH {CHECKED} SELECT {DIRTY_KEY}, left({ERROR}, 100) AS error FROM checked WHERE len(errors) > 0
    ORDER BY {DIRTY_KEY} LIMIT 3""",
)
put(
    "coerce_fields",
    f"""WITH {DIRTY} SELECT {DIRTY_KEY}, part_number, trunc(demand_quantity + 0.7)::INT AS demand_quantity,
    {rd('unit_cost', 2)} AS unit_cost, transaction_date, npi_signal FROM dirty""",
)

# Aggregates over the records

put(
    "outlier_flag",
    f"""WITH {SERIES}, spread AS (SELECT avg(demand_quantity) + 3 * stddev_samp(demand_quantity) AS cap FROM demand)
    SELECT count(*) FILTER (demand_quantity > cap) AS n_outliers, count(*) AS n_rows, {rd('max(cap)', 6)} AS outlier_limit
    FROM demand, spread""",
)
put(
    "dataset_summary",
    f"""WITH {FLAGGED} SELECT count(*) AS total_records, min(transaction_date) AS first_date, max(transaction_date) AS last_date,
    count(DISTINCT part_number) AS unique_parts, count(DISTINCT region) AS unique_regions,
    sum(is_zero_demand)::BIGINT AS zero_demand_rows, sum(is_demand_outlier)::BIGINT AS outlier_rows,
    sum(has_npi_signal)::BIGINT AS signal_rows, sum({NULLS})::BIGINT AS null_values FROM flagged""",
)
for name, column in (("demand_type_share", "demand_type"), ("region_share", "region")):
    put(
        name,
        f"""WITH {DEMAND} SELECT {column}, count(*) AS n_rows,
        {rd('count(*) / (SELECT count(*) FROM demand) * 100', 1)} AS share_pct FROM demand GROUP BY 1 ORDER BY 2 DESC, 1""",
    )

# Series features and split

BY_PART = "PARTITION BY part_number ORDER BY transaction_date, order_key, line_number"


def over(fn: str, rows: int) -> str:
    return f"{fn}(demand_quantity) OVER ({BY_PART} ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING)"


LAGS = ", ".join(f"lag(demand_quantity, {n}) OVER ({BY_PART}) AS lag_{n}" for n in fv.LAGS)
ROLLING = f"""{over('avg', 7)} AS rolling_mean_7, {over('avg', 14)} AS rolling_mean_14,
    {over('stddev_samp', 7)} AS rolling_std_7, {over('min', 7)} AS rolling_min_7, {over('max', 7)} AS rolling_max_7"""
put("lag_features", f"WITH {SERIES} SELECT {KEY}, demand_quantity, {LAGS} FROM demand")
put(
    "rolling_features",
    f"""WITH {SERIES}, r AS (SELECT {KEY}, {ROLLING} FROM demand) SELECT * REPLACE (
    {rd('rolling_mean_7', 6)} AS rolling_mean_7, {rd('rolling_mean_14', 6)} AS rolling_mean_14,
    {rd('rolling_std_7', 6)} AS rolling_std_7) FROM r""",
)
FILLED = ", ".join(
    f"coalesce({c}, 0) AS {c}"
    for c in (*[f"lag_{n}" for n in fv.LAGS], "rolling_mean_7", "rolling_mean_14", "rolling_std_7", "rolling_min_7", "rolling_max_7")
)
FEATURES = (
    DEMAND
    + f""",
series AS (SELECT *, {LAGS}, {ROLLING}, {DATE_PARTS}, {TYPE_CODE} AS demand_type_encoded,
                  {REGION_CODE} AS region_encoded, (npi_signal IS NOT NULL)::INT AS has_npi_signal FROM demand),
features AS (SELECT * REPLACE ({FILLED}) FROM series WHERE lag_1 IS NOT NULL)"""
)
ROUNDED = ("rolling_mean_7", "rolling_mean_14", "rolling_std_7", "unit_cost")
put(
    "features_complete",
    f"""WITH {FEATURES} SELECT {KEY}, demand_quantity,
    {", ".join(f"{rd(c, 6)} AS {c}" if c in ROUNDED else c for c in fv.FEATURE_COLUMNS)} FROM features""",
)
SPLIT = (
    FEATURES
    + f""",
ranked AS (SELECT *, row_number() OVER (ORDER BY transaction_date, part_number, order_key, line_number) - 1 AS rk,
                  count(*) OVER () AS n FROM features),
split AS (SELECT *, CASE WHEN rk < floor(n * (1 - {fv.TEST_SHARE}::DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM ranked),
test AS (SELECT * FROM split WHERE split = 'test')"""
)
put("time_split", f"WITH {SPLIT} SELECT {KEY}, split FROM split")
put(
    "split_summary",
    f"""WITH {SPLIT} SELECT split, count(*) AS n_rows, min(transaction_date) AS first_date, max(transaction_date) AS last_date
    FROM split GROUP BY 1""",
)
put(
    "naive_fallback",
    f"""WITH {SPLIT} SELECT {KEY}, demand_quantity, coalesce(lag(demand_quantity) OVER (ORDER BY rk), 0)::DOUBLE AS naive
    FROM test""",
)
put("forecast_naive", f"WITH {SPLIT} SELECT {KEY}, demand_quantity, lag_1::DOUBLE AS predicted FROM test")

# Seasonal smoothing

A, B, P = fv.SMOOTHING["alpha"], fv.SMOOTHING["beta"], fv.SMOOTHING["period"]
STATES = (
    SPLIT.lstrip("\n")
    + f""",
lists AS (SELECT part_number, list(demand_quantity::DOUBLE ORDER BY transaction_date, order_key, line_number) AS x,
                 count(*)::INT AS n FROM split WHERE split = 'train' GROUP BY 1),
fold(part_number, x, n, t, l, b, s) AS (
  SELECT part_number, x, n, {P}, list_avg(x[1:{P}]),
         CASE WHEN n >= {2 * P} THEN (list_avg(x[{P + 1}:{2 * P}]) - list_avg(x[1:{P}])) / {P} ELSE 0.0 END,
         list_transform(x[1:{P}], lambda v: CASE WHEN list_avg(x[1:{P}]) > 0 THEN v / list_avg(x[1:{P}]) ELSE 1.0 END)
  FROM lists WHERE n >= {P + 2}
  UNION ALL
  SELECT part_number, x, n, t + 1, nl, {B}::DOUBLE * (nl - l) + (1 - {B}::DOUBLE) * b,
         CASE WHEN nl > 0 THEN
           list_transform(s, lambda e, j: CASE WHEN j = t % {P} + 1
             THEN {A}::DOUBLE * (x[t + 1] / nl) + (1 - {A}::DOUBLE) * e ELSE e END)
         ELSE s END
  FROM (SELECT *, {A}::DOUBLE * (x[t + 1] / greatest(s[t % {P} + 1], {fv.SEASONAL_FLOOR}::DOUBLE))
                  + (1 - {A}::DOUBLE) * (l + b) AS nl FROM fold WHERE t < n)
),
states AS (
  SELECT part_number, CASE WHEN n < {P + 2} THEN 'mean' ELSE 'holt_winters' END AS type, lists.n,
         CASE WHEN n < {P + 2} THEN list_avg(x) END AS mean, l AS level, b AS trend, s AS seasonal,
         x[greatest(n - {P} + 1, 1):n] AS last_values
  FROM lists LEFT JOIN (SELECT part_number, l, b, s FROM fold WHERE t = n) USING (part_number)
)"""
)
STATE_ROWS = f"""SELECT part_number, type, n, {rd('mean', 6)} AS mean, {rd('level', 6)} AS level, {rd('trend', 6)} AS trend,
    array_to_string(list_transform(seasonal, lambda s: printf('%.6f', {rd('s', 6)})), ',') AS seasonal,
    array_to_string(list_transform(last_values, lambda v: v::INT::VARCHAR), ',') AS last_values FROM states"""
put("fit_seasonal", f"WITH RECURSIVE {STATES} {STATE_ROWS}")
put("model_state_roundtrip", f"WITH RECURSIVE {STATES} {STATE_ROWS}")
SCORED = (
    STATES
    + """,
scored AS (
  SELECT test.*, coalesce(CASE WHEN type = 'mean' THEN mean
           ELSE greatest((level + trend) * seasonal[day_of_week % len(seasonal) + 1], 0) END, 0)::DOUBLE AS predicted
  FROM test LEFT JOIN states USING (part_number)
)"""
)
YEARLY = SPLIT.replace(
    "test AS (SELECT * FROM split WHERE split = 'test')",
    "by_year AS (SELECT * REPLACE (part_number || '|' || year(transaction_date) AS part_number) FROM split), "
    "test AS (SELECT * FROM by_year WHERE split = 'test')",
)
YEARLY_SCORED = SCORED.replace(SPLIT.lstrip("\n"), YEARLY.lstrip("\n")).replace("FROM split WHERE split = 'train'", "FROM by_year WHERE split = 'train'")
put("fit_seasonal_yearly", f"WITH RECURSIVE {YEARLY_SCORED} {STATE_ROWS}")
put(
    "forecast_seasonal_yearly",
    f"WITH RECURSIVE {YEARLY_SCORED} SELECT {KEY}, demand_quantity, {rd('predicted', 6)} AS predicted FROM scored",
)
put("gbt_checked", f"WITH {SPLIT} SELECT {KEY}, demand_quantity::DOUBLE AS actual, true AS sound, true AS same_loaded FROM test")
put(
    "importance_checked",
    f"SELECT unnest([{values(fv.FEATURE_COLUMNS)}]) AS feature, true AS share, 1.0::DOUBLE AS total",
)
put("forecast_seasonal", f"WITH RECURSIVE {SCORED} SELECT {KEY}, demand_quantity, {rd('predicted', 6)} AS predicted FROM scored")

# Metrics

ERRORS = "abs(actual - predicted)"
MAE = mean(ERRORS)
RMSE = f"sqrt({mean('(actual - predicted) * (actual - predicted)')})"
MAPE = f"coalesce({mean('CASE WHEN actual > 0 THEN abs((actual - predicted) / actual) END')} * 100, 0)"
METRICS = (
    SCORED
    + f""",
lead AS (SELECT {KEY}, demand_type, demand_quantity::DOUBLE AS actual, predicted FROM scored),
predictions AS (
  SELECT *, {q(fv.SEASONAL_NAME)} AS model FROM lead UNION ALL
  SELECT {KEY}, demand_type, demand_quantity::DOUBLE, lag_1::DOUBLE, {q(fv.NAIVE_NAME)} FROM test
),
metrics AS (SELECT model, {rd(MAE, 2)} AS mae, {rd(RMSE, 2)} AS rmse, {rd(MAPE, 1)} AS mape FROM predictions GROUP BY 1)"""
)
put("model_metrics", f"WITH RECURSIVE {METRICS} SELECT * FROM metrics")
put(
    "metrics_all_checked",
    f"""WITH RECURSIVE {METRICS} SELECT model, mae, rmse, mape, true AS boosted_has_error FROM metrics
    UNION ALL SELECT {q(fv.BOOSTED_NAME)}, NULL, NULL, NULL, true""",
)
PART_METRICS = (
    METRICS
    + f""",
part_metrics AS (
  SELECT part_number, arg_min(demand_type, (transaction_date, order_key, line_number)) AS demand_type,
         {rd(MAE, 2)} AS mae, {rd(MAPE, 1)} AS mape FROM lead GROUP BY 1
)"""
)
put("per_part_metrics", f"WITH RECURSIVE {PART_METRICS} SELECT * FROM part_metrics")
put(
    "model_improvement",
    f"""WITH RECURSIVE {METRICS}, base AS (SELECT mae AS a, mape AS b FROM metrics WHERE model = {q(fv.NAIVE_NAME)})
    SELECT model, {rd('CASE WHEN a > 0 THEN (1 - mae / a) * 100 ELSE 0 END', 1)} AS mae_improvement,
    {rd('CASE WHEN b > 0 THEN (1 - mape / b) * 100 ELSE 0 END', 1)} AS mape_improvement
    FROM metrics, base WHERE model <> {q(fv.NAIVE_NAME)}""",
)
put(
    "best_model",
    f"""WITH RECURSIVE {METRICS}
    (SELECT 'mae' AS metric, model, mae AS value FROM metrics ORDER BY mae, model LIMIT 1) UNION ALL
    (SELECT 'mape', model, mape FROM metrics ORDER BY mape, model LIMIT 1)""",
)
SUMMARY = f"""count(*) AS total_predictions, {rd(mean('actual'), 2)} AS mean_actual,
    {rd(mean('predicted'), 2)} AS mean_predicted, {rd(MAE, 2)} AS mae FROM lead"""
put("forecast_summary", f"WITH RECURSIVE {METRICS} SELECT {SUMMARY}")
put("forecast_summary_part", f"WITH RECURSIVE {METRICS} SELECT {SUMMARY} WHERE part_number = 'AMAT-RF-7800-GEN'")
IN_TIME = "transaction_date, part_number, order_key, line_number"
put(
    "sample_predictions",
    f"""WITH RECURSIVE {METRICS} SELECT (row_number() OVER (ORDER BY {IN_TIME}) - 1)::INT AS index, {KEY}, actual,
    {rd('predicted', 6)} AS predicted FROM lead ORDER BY {IN_TIME} LIMIT 10""",
)
put(
    "forecast_chart",
    f"""WITH RECURSIVE {METRICS} SELECT (row_number() OVER (ORDER BY {IN_TIME}) - 1)::INT AS index, actual,
    {rd('predicted', 6)} AS predicted FROM lead ORDER BY {IN_TIME} LIMIT 50""",
)

# Profiles

PROFILE = f"""
part_profile AS (
  SELECT part_number, arg_min(demand_type, (transaction_date, order_key, line_number)) AS demand_type, region, n_days,
         {rd('avg(demand_quantity)', 1)} AS avg_demand, max(demand_quantity) AS max_demand, min(demand_quantity) AS min_demand,
         {rd('stddev_samp(demand_quantity)', 1)} AS std_demand, sum(demand_quantity)::BIGINT AS total_demand,
         {rd(mean('unit_cost'), 2)} AS unit_cost,
         {rd(mean('rolling_mean_7'), 1)} AS rolling_mean_7,
         {rd(mean('rolling_std_7'), 1)} AS rolling_std_7,
         min(transaction_date) AS first_date, max(transaction_date) AS last_date,
         sum(has_npi_signal)::BIGINT AS npi_days, {rd('sum(has_npi_signal) / count(*) * 100', 1)} AS npi_pct
  FROM features JOIN (
    SELECT part_number, region, sum(c) OVER (PARTITION BY part_number)::BIGINT AS n_days,
           row_number() OVER (PARTITION BY part_number ORDER BY c DESC, region) AS place
    FROM (SELECT part_number, region, count(*) AS c FROM features GROUP BY ALL)
    QUALIFY place = 1
  ) AS modal USING (part_number)
  GROUP BY part_number, modal.region, n_days
)""".replace("demand_type, region, n_days", "demand_type, modal.region AS region, n_days")
TREND = f"""
newest AS (SELECT *, row_number() OVER (PARTITION BY part_number
             ORDER BY transaction_date DESC, order_key DESC, line_number DESC) AS rn FROM features),
sides AS (SELECT part_number, count(*) AS n, avg(demand_quantity) FILTER (rn <= 7) AS recent,
                 avg(demand_quantity) FILTER (rn BETWEEN 8 AND 14) AS before FROM newest GROUP BY 1),
changes AS (SELECT part_number, n, CASE WHEN n >= 14 AND before > 0
                    THEN {rd('(recent - before) / before * 100', 1)} ELSE 0.0 END AS trend_pct FROM sides),
demand_trend AS (SELECT part_number, trend_pct, CASE WHEN n < 14 THEN {q(fv.TREND_SHORT)}
                   WHEN trend_pct > 5 THEN 'increasing' WHEN trend_pct < -5 THEN 'decreasing' ELSE 'stable' END AS trend
                 FROM changes)"""
put("part_profile", f"WITH {FEATURES}, {PROFILE} SELECT * FROM part_profile")
put("demand_trend", f"WITH {FEATURES}, {TREND} SELECT * FROM demand_trend")
put(
    "demand_by_type",
    f"""WITH {FEATURES} SELECT demand_type, {rd('avg(demand_quantity)', 2)} AS avg_daily_demand,
    {rd('stddev_samp(demand_quantity)', 2)} AS std_deviation, sum(demand_quantity)::BIGINT AS total_demand
    FROM features GROUP BY 1""",
)
PROFILES = (
    PART_METRICS
    + f""", {PROFILE}, {TREND},
classed AS (
  SELECT p.*, trend_pct, trend, mae, mape,
         CASE WHEN avg_demand > 0 AND std_demand / avg_demand > 0.5 THEN {q(fv.VOLATILITY_HIGH)}
              WHEN avg_demand > 0 AND std_demand / avg_demand > 0.3 THEN {q(fv.VOLATILITY_MODERATE)}
              ELSE {q(fv.VOLATILITY_LOW)} END AS volatility
  FROM part_profile p JOIN demand_trend USING (part_number)
  LEFT JOIN (SELECT part_number, mae, mape FROM part_metrics) USING (part_number)
),
risky AS (
  SELECT *, CASE WHEN trend = 'increasing' AND mape > 50 THEN {q(fv.RISK_HIGH)}
                 WHEN trend = 'increasing' THEN {q(fv.RISK_MODERATE_TREND)}
                 WHEN starts_with(volatility, 'high') THEN {q(fv.RISK_MODERATE_VOLATILE)}
                 ELSE {q(fv.RISK_LOW)} END AS risk_text FROM classed
),
profiles AS (
  SELECT *, split_part(risk_text, ' —', 1) AS stockout_risk,
         CASE WHEN starts_with(risk_text, 'HIGH') THEN {q(fv.ADVICE_HIGH)}
              WHEN starts_with(risk_text, 'MODERATE') THEN {q(fv.ADVICE_MODERATE)}
              ELSE {q(fv.ADVICE_LOW)} END AS advice FROM risky
)"""
)
put("volatility_class", f"WITH RECURSIVE {PROFILES} SELECT part_number, avg_demand, std_demand, volatility FROM profiles")
put(
    "stockout_risk",
    f"WITH RECURSIVE {PROFILES} SELECT part_number, trend, trend_pct, mape, stockout_risk, risk_text FROM profiles",
)
put("stock_recommendation", f"WITH RECURSIVE {PROFILES} SELECT part_number, stockout_risk, advice FROM profiles")

# Chunks


def filled(template: str, **marks: str) -> str:
    import re

    pieces = re.split(r"\{(\w+)\}", template)
    return " || ".join(f"({marks[p]})::VARCHAR" if i % 2 else q(p) for i, p in enumerate(pieces) if i % 2 or p)


PART_TEXT = filled(
    "\n\n".join(fv.PART_PARAGRAPHS),
    part="part_number",
    demand_type="demand_type",
    region="region",
    avg="printf('%.1f', avg_demand)",
    min="min_demand",
    max="max_demand",
    first="strftime(first_date, '%Y-%m-%d')",
    last="strftime(last_date, '%Y-%m-%d')",
    total="total_demand",
    volatility="volatility",
    trend="trend",
    trend_pct="printf('%+.1f', trend_pct::DOUBLE)",
    roll_mean="printf('%.1f', rolling_mean_7)",
    roll_std="printf('%.1f', rolling_std_7)",
    model=q(fv.SEASONAL_NAME),
    mae=f"coalesce({short('mae', 2)}, 'N/A')",
    mape="coalesce(printf('%.1f', mape), 'N/A')",
    cost="printf('%.2f', unit_cost)",
    signal_days="npi_days",
    days="n_days",
    signal_pct="printf('%.1f', npi_pct)",
    risk="risk_text",
    advice="advice",
)
PART_JSON = (
    "'{\"part_number\": \"' || part_number || '\", \"demand_type\": \"' || demand_type || '\", \"region\": \"' || region"
    " || '\", \"avg_demand\": ' || printf('%.1f', avg_demand) || ', \"trend\": \"' || trend"
    " || '\", \"stockout_risk\": \"' || stockout_risk || '\", \"source\": \"part_profile\"}'"
)
SUMMARY_LINES = filled(
    fv.SUMMARY_LINE, model="model", mae=short("mae", 2), rmse=short("rmse", 2), mape="printf('%.1f', mape)"
)
GAIN = filled(fv.SUMMARY_GAIN, model="best", gain="round_even((1 - best_mae / base) * 100, 0)::BIGINT")
SUMMARY_TEXT = (
    f"{q(fv.SUMMARY_HEADER + chr(10) * 2)} || lines || {q(chr(10) * 2)} || "
    + filled(fv.SUMMARY_BEST, model="best", mae=short("best_mae", 2))
    + f" || CASE WHEN best <> {q(fv.NAIVE_NAME)} AND base > 0 THEN {q(chr(10) * 2)} || {GAIN} ELSE '' END"
)
SUMMARY_CTE = f"""
ranks AS (SELECT *, CASE model WHEN {q(fv.BOOSTED_NAME)} THEN 0 WHEN {q(fv.SEASONAL_NAME)} THEN 1 ELSE 2 END AS r FROM metrics),
folded AS (SELECT string_agg({SUMMARY_LINES}, chr(10) ORDER BY r) AS lines, arg_min(model, (mae, r)) AS best,
                  min(mae) AS best_mae, max(mae) FILTER (model = {q(fv.NAIVE_NAME)}) AS base FROM ranks),
summary AS (SELECT {q(fv.SUMMARY_ID)} AS id, {SUMMARY_TEXT} AS text,
  '{{"source": "model_summary", "best_model": "' || best || '", "best_mae": ' || {short('best_mae', 2)} || '}}' AS metadata_json,
  best, best_mae FROM folded)"""
put("part_chunks", f"""WITH RECURSIVE {PROFILES} SELECT 'part_' || part_number AS id, {PART_TEXT} AS text,
    {PART_JSON} AS metadata_json, avg_demand FROM profiles""")
put("model_summary_chunk", f"WITH RECURSIVE {METRICS}, {SUMMARY_CTE} SELECT id, text, metadata_json, best_mae FROM summary")
DOMAIN_ROWS = ", ".join(
    f"({q(i)}, {q(t)}, {q(f'Demand type: {t} ({n})' + chr(10) * 2 + d)})" for i, (t, n, d) in enumerate(fv.DOMAIN_NOTES)
)
CHUNKS = (
    PROFILES
    + f""", {SUMMARY_CTE},
chunks AS (
  SELECT 'part_' || part_number AS id, {PART_TEXT} AS text, 'part_profile' AS source, {PART_JSON} AS metadata_json,
         [part_number, demand_type, region, trend, stockout_risk, 'part_profile'] AS vals, 0 AS kind, part_number AS seq,
         part_number AS part, demand_type, region, trend, stockout_risk AS risk, avg_demand, NULL::DOUBLE AS best_mae
  FROM profiles
  UNION ALL
  SELECT id, text, 'model_summary', metadata_json, ['model_summary', best], 1, '0', NULL, NULL, NULL, NULL, NULL, NULL, best_mae
  FROM summary
  UNION ALL
  SELECT 'demand_type_' || t, x, 'domain_knowledge', '{{"source": "domain_knowledge", "demand_type": "' || t || '"}}',
         ['domain_knowledge', t], 2, i, NULL, t, NULL, NULL, NULL, NULL, NULL FROM (VALUES {DOMAIN_ROWS}) AS d(i, t, x)
)"""
)
put("kb_all_chunks", f"WITH RECURSIVE {CHUNKS} SELECT id, text, source, metadata_json FROM chunks")
put("kb_json_roundtrip", f"WITH RECURSIVE {CHUNKS} SELECT id, text, source, demand_type, avg_demand, best_mae FROM chunks")
put("kb_counts", f"WITH RECURSIVE {CHUNKS} SELECT source, count(*) AS n_chunks FROM chunks GROUP BY 1")
put(
    "kpi_cards",
    f"""WITH RECURSIVE {CHUNKS} SELECT (SELECT count(*) FROM chunks WHERE source = 'part_profile') AS total_parts,
    model AS best_model, mae AS best_mae, mape AS best_mape FROM metrics ORDER BY mae, model LIMIT 1""",
)
put(
    "distinct_types",
    f"WITH RECURSIVE {CHUNKS} SELECT DISTINCT demand_type FROM chunks WHERE source = 'part_profile' ORDER BY 1",
)
LISTED = "part AS part_number, demand_type, region, trend, risk AS stockout_risk"
put("list_parts", f"WITH RECURSIVE {CHUNKS} SELECT {LISTED} FROM chunks WHERE source = 'part_profile'")
put(
    "list_parts_of_type",
    f"WITH RECURSIVE {CHUNKS} SELECT {LISTED} FROM chunks WHERE source = 'part_profile' AND demand_type = 'NPI'",
)
BUCKET = "CASE WHEN risk IN ('HIGH', 'MODERATE') THEN risk ELSE 'LOW' END AS bucket"
put("risk_listing", f"WITH RECURSIVE {CHUNKS} SELECT {LISTED}, {BUCKET} FROM chunks WHERE source = 'part_profile'")
put(
    "risk_buckets",
    f"WITH RECURSIVE {CHUNKS} SELECT {BUCKET}, count(*) AS n_parts FROM chunks WHERE source = 'part_profile' GROUP BY 1",
)

# Boosted trees of the short model: the split of the largest gain, found in sums by value


def split_level(tree: int, level: int) -> str:
    """Sends every row of ``at{tree}_{level}`` below or above the best split of its node."""
    at, name = f"at{tree}_{level}", f"{tree}_{level}"
    values = " UNION ALL ".join(f"SELECT node, {i} AS place, {q(c)} AS feature, {c}::DOUBLE AS v, y FROM {at} WHERE split = 'train'" for i, c in enumerate(SHORT))
    own = "CASE feature " + " ".join(f"WHEN {q(c)} THEN {c}" for c in SHORT) + " END"
    return f"""
sums{name} AS (SELECT node, place, feature, v, count(*) AS c, sum(y) AS s FROM ({values}) GROUP BY ALL),
sides{name} AS (
  SELECT node, place, feature, v, sum(c) OVER up AS nl, sum(s) OVER up AS sl, sum(c) OVER every AS n, sum(s) OVER every AS total
  FROM sums{name} WINDOW every AS (PARTITION BY node, place), up AS (PARTITION BY node, place ORDER BY v)
),
best{name} AS (
  SELECT node, {tree} AS tree, feature, (v + next) / 2 AS threshold, n,
         (sl * sl / nl + (total - sl) * (total - sl) / (n - nl) - total * total / n) / n AS gain
  FROM sides{name} JOIN borders USING (feature, v) WHERE nl < n AND next IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, place, v) = 1
),
at{tree}_{level + 1} AS MATERIALIZED (
  SELECT r.* REPLACE (CASE WHEN b.feature IS NULL OR b.gain <= 0 THEN r.node WHEN {own} <= threshold THEN 2 * r.node
                           ELSE 2 * r.node + 1 END AS node)
  FROM {at} r LEFT JOIN best{name} b ON b.node = r.node
)"""


def grown(tree: int, target: str, source: str) -> str:
    """A tree of two levels on ``target`` of ``source``; its leaf's mean is ``leaf{tree}``."""
    return f"""
at{tree}_0 AS MATERIALIZED (SELECT *, 1 AS node, {target} AS y FROM {source}),{split_level(tree, 0)},{split_level(tree, 1)},
tree{tree} AS MATERIALIZED (
  SELECT * EXCLUDE (node, y), avg(y) FILTER (split = 'train') OVER (PARTITION BY node) AS leaf{tree} FROM at{tree}_2
)"""


BORDERS = " UNION ALL ".join(f"SELECT DISTINCT {q(c)} AS feature, {c}::DOUBLE AS v FROM split WHERE split = 'train'" for c in SHORT)
TREES = f"""
borders AS MATERIALIZED (SELECT feature, v, lead(v) OVER (PARTITION BY feature ORDER BY v) AS next FROM ({BORDERS})),
seen AS MATERIALIZED (SELECT {KEY}, demand_type, split, {", ".join(SHORT)}, demand_quantity::DOUBLE AS actual FROM split),
{grown(0, 'actual', 'seen')},
{grown(1, '2 * (actual - leaf0)', 'tree0')},
boosted AS (SELECT *, greatest(leaf0 + {fv.BOOSTED['rate']}::DOUBLE * leaf1, 0) AS predicted FROM tree1 WHERE split = 'test'),
splits AS ({' UNION ALL '.join(f"SELECT tree, feature, threshold, n, gain FROM best{t}_{n} WHERE gain > 0" for t in (0, 1) for n in (0, 1))}),
shares AS (
  SELECT f.feature, coalesce(g / nullif(sum(g) OVER (), 0), 0) AS importance
  FROM (SELECT unnest([{values(SHORT)}]) AS feature) f
  LEFT JOIN (SELECT feature, sum(gain * n) AS g FROM splits GROUP BY 1) USING (feature)
)"""
put("forecast_gbt_short", f"WITH {SPLIT}, {TREES} SELECT {KEY}, actual, {rd('predicted', 6)} AS predicted FROM boosted")
put("forecast_gbt_walked", f"WITH {SPLIT}, {TREES} SELECT {KEY}, {rd('predicted', 6)} AS predicted FROM boosted")
put("gbt_splits", f"WITH {SPLIT}, {TREES} SELECT tree, feature, threshold, n::BIGINT AS n, {rd('gain', 6)} AS gain FROM splits")
put(
    "importance_short",
    f"""WITH {SPLIT}, {TREES}, r AS (SELECT feature, {rd('importance', 6)} AS importance FROM shares)
    SELECT row_number() OVER (ORDER BY importance DESC, feature)::INT AS rank, feature, importance FROM r""",
)
BOOSTED_METRICS = (
    SCORED
    + f""", {TREES},
lead AS (SELECT {KEY}, demand_type, actual, predicted FROM boosted),
predictions AS (
  SELECT *, {q(fv.BOOSTED_NAME)} AS model FROM lead UNION ALL
  SELECT {KEY}, demand_type, demand_quantity::DOUBLE, predicted, {q(fv.SEASONAL_NAME)} FROM scored UNION ALL
  SELECT {KEY}, demand_type, demand_quantity::DOUBLE, lag_1::DOUBLE, {q(fv.NAIVE_NAME)} FROM test
),
metrics AS (SELECT model, {rd(MAE, 2)} AS mae, {rd(RMSE, 2)} AS rmse, {rd(MAPE, 1)} AS mape FROM predictions GROUP BY 1)"""
)
put("model_metrics_short", f"WITH RECURSIVE {BOOSTED_METRICS} SELECT * FROM metrics")
put(
    "stockout_risk_boosted",
    f"""WITH RECURSIVE {BOOSTED_METRICS}{PROFILES.removeprefix(METRICS)}
    SELECT part_number, trend, trend_pct, mae, mape, volatility, stockout_risk, risk_text, advice FROM profiles""",
)
# The summary's last sentence: the first three features.
SHARE = short("round_even(importance * 1000, 0) / 10", 1)
FEATURE = f"feature || ' (' || {SHARE} || CASE WHEN place = 1 THEN '% importance)' ELSE '%)' END"
NAMED = f"""(SELECT string_agg({FEATURE}, ', ' ORDER BY place) FROM (
    SELECT *, row_number() OVER (ORDER BY importance DESC, feature) AS place FROM shares) WHERE place <= 3)"""
put(
    "kb_chunks_boosted",
    f"""WITH RECURSIVE {BOOSTED_METRICS}{CHUNKS.removeprefix(METRICS).replace(f"({q(fv.SEASONAL_NAME)})::VARCHAR", f"({q(fv.BOOSTED_NAME)})::VARCHAR")}
    SELECT id, CASE source WHEN 'model_summary' THEN text || {q(chr(10) * 2)} || {filled(fv.SUMMARY_FEATURES, features=NAMED)}
                           ELSE text END AS text, source, metadata_json FROM chunks""",
)

# Retrieval

SPACE = "[" + "".join(f"\\x{{{c:x}}}" for c in SPACE_CODES) + "]+"
STOP = f"[{values(fv.STOP_WORDS)}]"


def terms_of(text: str) -> str:
    words = f"list_distinct(list_filter(regexp_split_to_array(lower({text}), {q(SPACE)}), lambda w: w <> ''))"
    return f"list_filter({words}, lambda w: NOT list_contains({STOP}, w))"


put(
    "query_terms",
    f"""SELECT conv_id, turn, role, len(terms)::INT AS n_terms, array_to_string(list_sort(terms), ' ') AS terms
    FROM (SELECT conv_id, turn, role, {terms_of('text')} AS terms FROM conversations)""",
)
INTENT = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"contains(lower(text), {q(w)})" for w in words) + f" THEN {q(name)}"
    for name, words in fv.INTENT_WORDS
) + f" ELSE {q(fv.INTENT_OTHER)} END"
put(
    "question_intent",
    f"""SELECT kind, a, b, {INTENT} AS intent FROM (
    SELECT 'turn' AS kind, conv_id AS a, turn AS b, text FROM conversations UNION ALL
    SELECT 'document', doc_id, 0::BIGINT, text FROM documents)""",
)


def hits(questions, k: int) -> str:
    """Hits of a list of questions, or of a table expression with qid and question."""
    rows = questions if isinstance(questions, str) else "(VALUES " + ", ".join(f"({i}, {q(text)})" for i, text in enumerate(questions)) + ") AS a(qid, question)"
    return f"""
asked AS (SELECT qid, question, {terms_of('question')} AS terms FROM {rows}),
bodies AS (SELECT *, lower(text) || ' ' || lower(metadata_json) AS body FROM chunks),
points AS (
  SELECT qid, question, terms, bodies.*,
    (list_sum(list_transform(terms, lambda t: contains(body, t)::INT
       + {fv.METADATA_BONUS} * len(list_filter(vals, lambda v: contains(lower(v), t)))))
     + CASE WHEN contains(body, lower(question)) THEN {fv.PHRASE_BONUS} ELSE 0 END) / len(terms) AS score
  FROM asked, bodies
),
hits AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY coalesce(score, 0) DESC, kind, seq)::INT AS rank
         FROM points QUALIFY rank <= {k})"""


HIT_ROWS = f"SELECT qid, rank, id, {rd('coalesce(score, 0)', 6)} AS score FROM hits"
FOUND = f"{CHUNKS}, {hits(fv.SAMPLE_QUESTIONS, 3)}"
put("kb_keyword_search", f"WITH RECURSIVE {FOUND} {HIT_ROWS}")
put(
    "document_keyword_search",
    f"""WITH chunks AS (SELECT doc_id::VARCHAR AS id, text, '{{"lang": "' || lang || '", "source": "' || source || '"}}' AS metadata_json,
    [lang, source] AS vals, 0 AS kind, doc_id AS seq FROM documents), {hits(DOCUMENT_QUESTIONS, 10)} {HIT_ROWS}""",
)


def near(where: str) -> str:
    return f"""WITH dims AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    means AS (SELECT label, i, sum(x::DECIMAL(28,10))::DOUBLE / count(*) AS m FROM dims GROUP BY ALL),
    centers AS (SELECT label, list(m ORDER BY i) AS c FROM means GROUP BY 1),
    asked AS (SELECT row_number() OVER (ORDER BY label) - 1 AS qid, c FROM centers),
    gaps AS (SELECT qid, vec_id, list_sum(list_transform(list_zip(embedding, c),
               lambda p: (p[1]::DOUBLE - p[2]) * (p[1]::DOUBLE - p[2]))) AS distance FROM asked, embeddings WHERE {where})
    SELECT qid::INT AS qid, row_number() OVER (PARTITION BY qid ORDER BY distance, vec_id)::INT AS rank, vec_id,
           {rd('distance', 6)} AS distance FROM gaps QUALIFY rank <= 3"""


def embedded(source: str, key: str) -> str:
    """Numbered terms and unit weights of a table of texts."""
    return f"""held AS (SELECT {key} AS key, w AS term, count(*) AS n
      FROM (SELECT {key}, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')) AS w FROM {source}) GROUP BY ALL),
    dictionary AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS number, ln(((SELECT count(*) FROM {source}) + 1)::DOUBLE / (count(*) + 1)) AS idf
      FROM held GROUP BY term),
    weighed AS (SELECT key, term, number, n * idf AS w FROM held JOIN dictionary USING (term) WHERE idf > 0),
    unit AS (SELECT key, term, number, w / sqrt(sum(w * w) OVER (PARTITION BY key)) AS w FROM weighed)"""


def vector_sums(source: str, key: str) -> str:
    return f"""SELECT {key}, count(number)::INT AS size, {rd('coalesce(sum(w * w), 0)', 6)} AS norm,
    {rd('coalesce(sum(w * (number % 1009 + 1)), 0)', 6)} AS checksum FROM {source} LEFT JOIN unit ON unit.key = {key} GROUP BY {key}"""


put("embed_chunks", f"WITH RECURSIVE {CHUNKS}, {embedded('chunks', 'id')} {vector_sums('chunks', 'id')}")
put("embed_documents", f"WITH {embedded('documents', 'doc_id')} {vector_sums('documents', 'doc_id')}")

put("vector_search", near("true"))
put("vector_search_filtered", near("label = 3"))

CONTEXT = f"string_agg(text, {q(fv.CONTEXT_RULE)} ORDER BY rank)"
put("rag_context", f"WITH RECURSIVE {FOUND} SELECT qid, {CONTEXT} AS context FROM hits GROUP BY qid")
put(
    "rag_prompt",
    f"""WITH RECURSIVE {FOUND} SELECT qid, {filled(fv.PROMPT_TEMPLATE, context=CONTEXT, question='max(question)')} AS prompt
    FROM hits GROUP BY qid""",
)

# Answers: the text each hit contributes, joined in rank order.


def lines(keep: str) -> str:
    picked = f"list_filter(string_split(text, chr(10)), lambda s: {keep})"
    return f"array_to_string(list_transform({picked}, lambda s: '  ' || trim(s) || chr(10)), '')"


def any_word(words) -> str:
    return " OR ".join(f"contains(lower(s), {q(w)})" for w in words)


IS_PART = "source = 'part_profile'"
ENTRY = "'  - ' || part || ' (' || demand_type || ', trend: ' || trend || ')' || chr(10)"


def joined(piece: str, where: str) -> str:
    return f"coalesce(string_agg({piece}, '' ORDER BY rank) FILTER ({where}), '')"


def risk_group(level: str, title: str) -> str:
    which = f"{IS_PART} AND " + (f"risk = {q(level)}" if level != "LOW" else "risk NOT IN ('HIGH', 'MODERATE')")
    return (
        f"CASE WHEN count(*) FILTER ({which}) > 0 THEN {q(title + chr(10))} || {joined(ENTRY, which)} || chr(10) ELSE '' END"
    )


def opening(intent: str) -> str:
    return q(fv.ANSWER_OPENINGS[intent] + "\n\n")


ANSWERS = {
    "risk": " || ".join(
        [opening("risk")]
        + [risk_group(level, title) for level, title in fv.RISK_GROUPS]
        + [f"CASE WHEN count(*) FILTER ({IS_PART}) = 0 THEN {q(fv.RISK_NONE + chr(10) * 2)} ELSE '' END"]
        + [q(fv.RISK_DETAILS + "\n"), joined(lines(any_word(fv.RISK_LINE_WORDS)), f"{IS_PART} AND rank <= 2")]
    ),
    "forecast": f"{opening('forecast')} || "
    + joined(
        f"CASE WHEN source = 'model_summary' THEN text || {q(chr(10) * 2)} ELSE {lines(any_word(fv.FORECAST_LINE_WORDS))} END",
        f"{IS_PART} OR source = 'model_summary'",
    ),
    "compare": f"{opening('compare')} || "
    + joined(
        f"'--- ' || part || ' (' || demand_type || ') ---' || chr(10) || "
        + lines("trim(s) <> '' AND NOT starts_with(trim(s), 'Part ')")
        + " || chr(10)",
        IS_PART,
    ),
    "recommend": f"{opening('recommend')} || " + joined(lines(any_word(fv.RECOMMEND_LINE_WORDS)), "true"),
    "trend": f"{opening('trend')} || "
    + joined(f"part || ':' || chr(10) || {lines(any_word(fv.TREND_LINE_WORDS))} || chr(10)", IS_PART),
    "general": f"{opening('general')} || "
    + joined(
        f"CASE WHEN {IS_PART} THEN '--- ' || part || ' ---' || chr(10) ELSE '' END || left(text, 500) || {q(chr(10) * 2)}",
        "rank <= 3",
    ),
}
ROUTED = INTENT.replace("lower(text)", "lower(max(question))")
TURNS = "(SELECT conv_id * 100000 + turn AS qid, coalesce(text, '') AS question FROM conversations WHERE role = 'user') AS a"
put(
    "answer_user_turns",
    f"""WITH RECURSIVE {CHUNKS}, {hits(TURNS, 3)} SELECT qid // 100000 AS conv_id, qid % 100000 AS turn,
    CASE {ROUTED} {" ".join(f"WHEN {q(k)} THEN {v}" for k, v in ANSWERS.items())} END AS answer,
    string_agg(id, ',' ORDER BY rank) AS sources, count(*)::INT AS num_sources FROM hits GROUP BY qid""",
)
put(
    "answer_batch",
    f"""WITH RECURSIVE {FOUND} SELECT qid, max(question) AS question,
    CASE {ROUTED} {" ".join(f"WHEN {q(k)} THEN {v}" for k, v in ANSWERS.items())} END AS answer,
    string_agg(id, ',' ORDER BY rank) AS sources, count(*)::INT AS num_sources FROM hits GROUP BY qid""",
)
VALUES = ", ".join(f"({i}, {q(text)})" for i, text in enumerate(fv.SAMPLE_QUESTIONS))
NEAREST = f"""asked AS (SELECT * FROM (VALUES {VALUES}) AS a(qid, question)),
said AS (SELECT qid, w AS term, count(*) AS n
  FROM (SELECT qid, unnest(list_filter(regexp_split_to_array(lower(question), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')) AS w FROM asked) GROUP BY ALL),
wanted AS (SELECT qid, term, n * idf AS w FROM said JOIN dictionary USING (term) WHERE idf > 0),
cosines AS (SELECT qid, key, {rd('sum(q.w / length * unit.w)', 9)} AS cosine
  FROM (SELECT *, sqrt(sum(w * w) OVER (PARTITION BY qid)) AS length FROM wanted) q JOIN unit USING (term) GROUP BY qid, key),
hits AS (SELECT asked.*, chunks.*, row_number() OVER (PARTITION BY qid ORDER BY cosine DESC, id) AS rank
  FROM cosines JOIN asked USING (qid) JOIN chunks ON chunks.id = cosines.key QUALIFY rank <= 3)"""
put(
    "answer_batch_vector",
    f"""WITH RECURSIVE {CHUNKS}, {embedded('chunks', 'id')}, {NEAREST} SELECT qid::INT AS qid, max(question) AS question,
    CASE {ROUTED} {" ".join(f"WHEN {q(k)} THEN {v}" for k, v in ANSWERS.items())} END AS answer,
    string_agg(id, ',' ORDER BY rank) AS sources, count(*)::INT AS num_sources FROM hits GROUP BY qid""",
)
