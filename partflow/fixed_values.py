"""Vocabulary, lookup tables, constants and text formats.

Everything here has to be exactly what it is for results to be right. There is
no logic in this module.
"""

# Closed vocabularies of the demand record.
DEMAND_TYPES = ("NPI", "standard", "service_campaign", "reliability")
REGIONS = ("North America", "Asia Pacific", "Europe")

# Recode tables from the raw retail names to the demand schema.
DEPT_TO_DEMAND_TYPE = {
    "HOBBIES_1": "NPI",
    "HOBBIES_2": "NPI",
    "HOUSEHOLD_1": "standard",
    "HOUSEHOLD_2": "standard",
    "FOODS_1": "service_campaign",
    "FOODS_2": "service_campaign",
    "FOODS_3": "reliability",
}
STORE_TO_REGION = {
    "CA_1": "North America",
    "CA_2": "North America",
    "CA_3": "North America",
    "CA_4": "North America",
    "TX_1": "North America",
    "TX_2": "North America",
    "TX_3": "North America",
    "WI_1": "Asia Pacific",
    "WI_2": "Asia Pacific",
    "WI_3": "Europe",
}
ITEM_TO_PART_NUMBER = {
    "HOBBIES_1_001": "AMAT-RF-7800-GEN",
    "HOBBIES_1_008": "AMAT-RF-7800-CTRL",
    "HOBBIES_2_004": "AMAT-LITH-5500-ALIGN",
    "HOUSEHOLD_1_012": "AMAT-CVD-3200-VALVE",
    "HOUSEHOLD_2_067": "AMAT-CVD-3200-SEAL",
    "FOODS_1_001": "AMAT-CMP-4100-PAD",
    "FOODS_2_099": "AMAT-CMP-4100-SLURRY",
    "FOODS_3_042": "AMAT-ETCH-6600-RING",
}
CATEGORY_TO_DESCRIPTION = {
    "HOBBIES": "RF & Lithography Components",
    "HOUSEHOLD": "CVD Gas Delivery Systems",
    "FOODS": "CMP & Etch Consumables",
}
EVENT_TO_SIGNAL = {
    "SuperBowl": "AMAT_TechNode_3nm_Launch",
    "NPI_Launch_Q1": "AMAT_Producer_SE_Release",
    "ServiceCampaign_A": "AMAT_FieldUpgrade_CVD3200",
}
DEFAULT_DEMAND_TYPE = "standard"
DEFAULT_REGION = "North America"
DEFAULT_UNIT_COST = 0.01

# Ordinal codes of the categorical features; anything else is UNKNOWN_CODE.
DEMAND_TYPE_CODES = {"NPI": 0, "standard": 1, "service_campaign": 2, "reliability": 3}
REGION_CODES = {"North America": 0, "Asia Pacific": 1, "Europe": 2}
UNKNOWN_CODE = -1

# Output column order of the demand record, and its names in the raw table.
DEMAND_COLUMNS = (
    "part_number",
    "demand_type",
    "region",
    "demand_quantity",
    "transaction_date",
    "unit_cost",
    "part_description",
    "npi_signal",
)
RAW_TO_DEMAND = {
    "item_id": "part_number",
    "sales": "demand_quantity",
    "date": "transaction_date",
    "sell_price": "unit_cost",
    "cat_id": "part_description",
    "event_name_1": "npi_signal",
}

# Model inputs and target.
FEATURE_COLUMNS = (
    "day_of_week", "day_of_month", "week_of_year", "month", "quarter",
    "is_weekend", "is_month_start", "is_month_end",
    "lag_1", "lag_3", "lag_7", "lag_14",
    "rolling_mean_7", "rolling_mean_14", "rolling_std_7",
    "rolling_min_7", "rolling_max_7",
    "demand_type_encoded", "region_encoded", "has_npi_signal",
    "unit_cost",
)
TARGET_COLUMN = "demand_quantity"
LAGS = (1, 3, 7, 14)
TEST_SHARE = 0.2

# Boosted-tree and smoothing parameters.
BOOSTED = {"trees": 100, "depth": 6, "rate": 0.1, "row_share": 0.8, "seed": 42}
SMOOTHING = {"alpha": 0.3, "beta": 0.1, "period": 7}
SEASONAL_FLOOR = 0.01

# Model names in metric tables and texts.
BOOSTED_NAME = "XGBoost"
SEASONAL_NAME = "ARIMA"
NAIVE_NAME = "Naive (lag_1)"

# Messages of the record checks.
CHECK_HEADER = "Validation failed for record:"
CHECK_MESSAGES = {
    "part_number": "part_number must be a non-empty string",
    "demand_type": "demand_type '%s' is not valid. Must be one of: NPI, standard, service_campaign, reliability",
    "region": "region '%s' is not valid. Must be one of: North America, Asia Pacific, Europe",
    "quantity_type": "demand_quantity must be an integer",
    "quantity_sign": "demand_quantity cannot be negative (got %s)",
    "cost_type": "unit_cost must be a number",
    "cost_sign": "unit_cost must be positive (got %s)",
    "date": "transaction_date '%s' is not valid. Must be format YYYY-MM-DD",
    "part_description": "part_description must be a non-empty string",
    "no_record": "record must be an object of distinct fields",
    "unknown_field": "unexpected field '%s'",
    "missing_field": "missing required field '%s'",
}
#: The one field that a record may lack.
OPTIONAL_FIELD = "npi_signal"

# Wording of a part profile.
VOLATILITY_HIGH = "high volatility (coefficient of variation > 0.5)"
VOLATILITY_MODERATE = "moderate volatility"
VOLATILITY_LOW = "low volatility (stable demand)"
RISK_HIGH = "HIGH — demand is increasing and forecast uncertainty is high"
RISK_MODERATE_TREND = "MODERATE — demand is increasing but forecasts are reasonably accurate"
RISK_MODERATE_VOLATILE = "MODERATE — demand is volatile and hard to predict"
RISK_LOW = "LOW — demand is stable and predictable"
ADVICE_HIGH = "Increase safety stock by 15-20% due to high demand uncertainty and upward trend."
ADVICE_MODERATE = "Increase safety stock by 10% due to rising demand or volatility."
ADVICE_LOW = "Maintain current stock levels. Demand is predictable."
TREND_SHORT = "insufficient data"

# Paragraphs of a part chunk; the marks are filled from the profile columns.
PART_PARAGRAPHS = (
    "Part {part} is a {demand_type}-type semiconductor component primarily serving the {region} region.",
    "Demand profile: Average daily demand is {avg} units (range: {min} to {max} units). Total demand over the "
    "observation period ({first} to {last}) was {total} units. The demand shows {volatility}.",
    "Recent trend: Demand is {trend} ({trend_pct}% change, last 7 days vs previous 7 days). The 7-day rolling "
    "average demand is {roll_mean} units with rolling standard deviation of {roll_std}.",
    "Forecast accuracy: {model} forecast achieves MAE of {mae} units and MAPE of {mape}%. Unit cost is ${cost}.",
    "NPI signals: {signal_days} out of {days} days had NPI or event signals ({signal_pct}% of days).",
    "Stockout risk assessment: {risk}.",
    "Recommendation: {advice}",
)

# Model summary chunk.
SUMMARY_ID = "model_comparison_summary"
SUMMARY_HEADER = "Model comparison results for demand forecasting:"
SUMMARY_LINE = "- {model}: MAE = {mae} units, RMSE = {rmse} units, MAPE = {mape}%"
SUMMARY_BEST = "Best performing model: {model} with MAE of {mae} units."
SUMMARY_GAIN = (
    "The {model} model outperformed the naive baseline (predict tomorrow = today) by approximately {gain}% on MAE. "
    "This demonstrates that the model learned genuine demand patterns beyond simple repetition."
)
SUMMARY_FEATURES = (
    "Top predictive features: {features}. "
    "This confirms that recent demand trends and part category are the strongest drivers of future demand."
)

# Domain chunks: demand type, its full name, its description.
DOMAIN_NOTES = (
    (
        "NPI",
        "New Product Introduction",
        "NPI parts are components for newly launched semiconductor equipment. Demand pattern is characterized by "
        "sudden spikes when a new product is announced, followed by gradual stabilization. NPI demand is the hardest "
        "to predict (highest MAPE) due to its volatile, event-driven nature. Safety stock should be 20-30% above "
        "average to buffer against forecast uncertainty. Example parts: AMAT-RF-7800-GEN (RF generator), "
        "AMAT-LITH-5500-ALIGN (lithography alignment sensor).",
    ),
    (
        "standard",
        "Standard replacement parts",
        "Standard parts are routine replacement components that factories consistently need. Demand pattern is "
        "steady and predictable with low variance. These parts have the lowest MAPE (best forecast accuracy). Safety "
        "stock can be minimal (5-10% above average) since demand is reliable. Example parts: AMAT-CVD-3200-VALVE "
        "(gas delivery valve), AMAT-CVD-3200-SEAL (chamber seal ring).",
    ),
    (
        "service_campaign",
        "Service campaign and warranty parts",
        "Service campaign parts see demand spikes during product recalls, warranty programs, or field upgrade "
        "campaigns. Demand pattern shows sharp spikes when a campaign launches, then drops back to baseline when the "
        "campaign ends. Forecast accuracy is moderate. Safety stock should be increased 2-4 weeks before a planned "
        "campaign. Example parts: AMAT-CMP-4100-PAD (polishing pad), AMAT-CMP-4100-SLURRY (slurry pump).",
    ),
    (
        "reliability",
        "Reliability and wear parts",
        "Reliability parts are components that degrade over time through normal use. Demand pattern shows gradual, "
        "steady increase as the installed base of equipment ages. These parts are moderately predictable. Safety "
        "stock should increase proportionally with the installed base growth rate. Example: AMAT-ETCH-6600-RING "
        "(etch chamber focus ring that wears out).",
    ),
)

# Retrieval: stop words, score weights, intents in the order they are tried.
STOP_WORDS = (
    "the", "a", "an", "is", "are", "what", "which", "how",
    "does", "do", "in", "for", "of", "to", "and", "or",
    "my", "our", "this", "that", "with", "by", "at", "from",
)
PHRASE_BONUS = 3
METADATA_BONUS = 2
INTENT_WORDS = (
    ("risk", ("risk", "stockout", "shortage", "danger")),
    ("forecast", ("forecast", "predict", "accuracy", "mape", "mae")),
    ("compare", ("compare", "vs", "versus", "difference")),
    ("recommend", ("recommend", "suggestion", "should", "action")),
    ("trend", ("trend", "increasing", "decreasing", "growing")),
)
INTENT_OTHER = "general"
TOP_K_MIN, TOP_K_DEFAULT, TOP_K_MAX = 1, 3, 10

# Answer wording, and the words that pick a line out of a chunk.
ANSWER_EMPTY = (
    "I don't have enough data to answer that question. "
    "Please make sure the knowledge base has been built."
)
ANSWER_OPENINGS = {
    "risk": "Based on the supply chain data analysis:",
    "forecast": "Forecast performance summary:",
    "compare": "Comparison based on available data:",
    "recommend": "Recommendations based on analysis:",
    "trend": "Demand trends:",
    "general": "Here's what I found relevant to your question:",
}
RISK_GROUPS = (
    ("HIGH", "HIGH RISK parts (immediate attention needed):"),
    ("MODERATE", "MODERATE RISK parts (monitor closely):"),
    ("LOW", "LOW RISK parts (stable):"),
)
RISK_NONE = "No parts with specific risk assessments found in the retrieved data."
RISK_DETAILS = "Details:"
RISK_LINE_WORDS = ("risk", "trend", "recommendation")
FORECAST_LINE_WORDS = ("forecast", "mae", "mape", "accuracy")
RECOMMEND_LINE_WORDS = ("recommend", "safety stock", "increase", "maintain")
TREND_LINE_WORDS = ("trend", "increasing", "decreasing", "stable", "rolling")
CONTEXT_RULE = "\n\n---\n\n"

PROMPT_TEMPLATE = (
    "You are an expert supply chain analyst for a semiconductor equipment company (Applied Materials / AMAT). You "
    "help supply chain managers make decisions about inventory, demand forecasting, and stockout risk.\n"
    "\n"
    "RULES:\n"
    "1. Answer ONLY based on the context data provided below.\n"
    "2. If the data doesn't contain enough information, say so clearly.\n"
    "3. Always cite specific numbers (MAE, MAPE, demand averages) from the context.\n"
    "4. Provide actionable recommendations when appropriate.\n"
    "5. Be concise but thorough. Use bullet points for clarity.\n"
    "6. Never make up data or statistics that aren't in the context.\n"
    "\n"
    "CONTEXT DATA:\n"
    "{context}\n"
    "\n"
    "USER QUESTION:\n"
    "{question}\n"
    "\n"
    "ANSWER:"
)

# The questions the service is shown off with.
SAMPLE_QUESTIONS = (
    "Which parts are at stockout risk?",
    "What is the forecast accuracy for NPI parts?",
    "Tell me about AMAT-RF-7800-GEN demand trends",
    "What are the recommendations for safety stock?",
    "Compare standard vs NPI demand patterns",
)

# Sample data: Poisson mean by department prefix, tried in order; weekend lift;
# the event drawn per row; calendar constants.
SAMPLE_ITEMS = (
    "HOBBIES_1_001", "HOBBIES_1_008", "HOBBIES_2_004",
    "HOUSEHOLD_1_012", "HOUSEHOLD_2_067",
    "FOODS_1_001", "FOODS_2_099", "FOODS_3_042",
)
SAMPLE_STORES = ("CA_1", "CA_2", "TX_1", "TX_3", "WI_1", "WI_3")
SAMPLE_MEANS = (("HOBBIES", 5), ("HOUSEHOLD", 12), ("FOODS_3", 8))
SAMPLE_MEAN_OTHER = 10
SAMPLE_WEEKEND_LIFT = 1.3
SAMPLE_EVENTS = (
    None, None, None, None, None, "SuperBowl", "NPI_Launch_Q1", "ServiceCampaign_A", None, None,
)
SAMPLE_START = "2015-01-01"
SAMPLE_DAYS = 30
SAMPLE_PRICE_WEEKS = 5
FIRST_WEEK = 11101
SNAP_DAYS = {"snap_CA": 3, "snap_TX": 2, "snap_WI": 4}
EVENT_KIND = "Cultural"
