"""Fixed values that define the data model.

Everything in this module is a FIXED VALUE: column lists, token lists,
thresholds and industry ranges that must equal the behaviour being
reproduced for results to match. They are stated plainly, in natural
order, and are not derived from anything.
"""

from __future__ import annotations

# --- FIXED VALUES: quarterly accounting panel ------------------------------

# Columns read as text; every other input column is coerced to a number.
STRING_COLUMNS = ["costat", "curcdq", "datafmt", "indfmt", "consol", "tic", "cusip", "gvkey"]

# Core accounting columns that get a `<col>_missing` indicator.
CORE_NUMERIC_COLUMNS = [
    "actq", "atq", "cogsq", "dlttq", "lctq", "ltq", "niq",
    "oibdpq", "saleq", "xsgaq", "capxy", "oancfy", "rstcheq",
]

# Balance-sheet stocks that can never be negative.
NONNEGATIVE_STOCK_COLUMNS = ["actq", "atq", "dlttq", "lctq", "ltq", "rstcheq", "rstcheltq"]
STOCK_RULE = "balance_sheet_stock_must_be_nonnegative"

# Accounting flows treated as non-negative for the ratios.
NONNEGATIVE_FLOW_COLUMNS = ["saleq", "cogsq", "xsgaq", "capxy", "dvintfq", "npatq"]
FLOW_RULE = "nonnegative_accounting_flow_set_to_missing"

HIGH_MISSING_THRESHOLD = 0.90

ENTITY_KEY = "gvkey_str"
DATE_COL = "datadate"
TARGET_COL = "target_next_niq_growth"

# Strings that mean "missing" after trimming and upper-casing.
CLEANED_NULL_TOKENS = ["", "NAN", "NONE", "NULL", "<NA>"]

# Raw CSV fields that the pandas CSV reader turns into missing by default
# (matched exactly, before any trimming).
CSV_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# Two-digit SIC division ranges, inclusive bounds, checked in this order.
SIC_DIVISIONS = [
    (100, 999, "Agriculture"),
    (1000, 1499, "Mining"),
    (1500, 1799, "Construction"),
    (2000, 3999, "Manufacturing"),
    (4000, 4999, "Transportation"),
    (5000, 5199, "Wholesale"),
    (5200, 5999, "Retail"),
    (6000, 6799, "Finance"),
    (7000, 8999, "Services"),
    (9100, 9729, "Public Administration"),
]
SIC_OTHER = "Other"
SIC_UNKNOWN = "Unknown"

# Safe division: denominators with |den| <= this are treated as missing.
SAFE_DIVIDE_MIN_ABS = 1e-9

# Valid gap (days, inclusive) between a row and the next row of the same
# entity for the next-quarter targets.
NEXT_GAP_MIN_DAYS = 45
NEXT_GAP_MAX_DAYS = 190

# Chronological split fractions over sorted distinct dates.
TRAIN_FRACTION = 0.70
VALIDATION_FRACTION = 0.85

# Feature lists (kept if present in the frame).
NUMERIC_FEATURES = [
    "actq", "atq", "cogsq", "dlttq", "lctq", "ltq", "niq", "oibdpq", "saleq", "xsgaq",
    "capxq_approx", "oancfq_approx", "calendar_year", "calendar_month", "is_calendar_year_end",
    "book_equity_proxy", "log_assets", "liabilities_to_assets", "debt_to_assets",
    "equity_to_assets", "current_ratio", "cash_like_to_assets", "roa", "roe_proxy",
    "profit_margin", "ebitda_margin", "gross_margin", "sgna_to_sales", "asset_turnover",
    "operating_cf_to_assets", "capex_to_assets", "sales_growth_qoq", "niq_growth_qoq",
    "asset_growth_qoq", "cluster_pca1", "cluster_pca2",
]
CATEGORICAL_FEATURES = ["costat", "curcdq", "sic2", "sic_division", "calendar_quarter", "finance_cluster"]
CLUSTER_FEATURES = [
    "log_assets", "liabilities_to_assets", "debt_to_assets", "equity_to_assets",
    "current_ratio", "roa", "profit_margin", "ebitda_margin", "gross_margin",
    "asset_turnover", "operating_cf_to_assets", "capex_to_assets",
    "sales_growth_qoq", "asset_growth_qoq",
]
CORRELATION_FEATURES = [
    "log_assets", "liabilities_to_assets", "debt_to_assets", "current_ratio", "roa",
    "profit_margin", "ebitda_margin", "gross_margin", "asset_turnover",
    "sales_growth_qoq", "asset_growth_qoq", TARGET_COL,
]

# Preprocessing parameters.
CLIP_LOWER = 0.01
CLIP_UPPER = 0.99
MIN_CATEGORY_FREQUENCY = 20
INFREQUENT_LEVEL = "__infrequent__"
CATEGORY_MISSING = "Unknown"
RANDOM_STATE = 42
N_CLUSTERS = 6
N_CLUSTER_RESTARTS = 20
N_PCA_COMPONENTS = 2
PLOT_SAMPLE_SIZE = 25000
TOP_MISSING = 20

# --- FIXED VALUES: daily security price panel -------------------------------

PRICE_REQUIRED_COLUMNS = [
    "PERMNO", "HdrCUSIP", "PrimaryExch", "ShareType", "Ticker", "PERMCO",
    "DlyCalDt", "DlyPrc", "DlyRet", "DlyVol", "ShrOut",
]
PRICE_STRING_COLUMNS = ["HdrCUSIP", "PrimaryExch", "ShareType", "Ticker"]
PRICE_INT_COLUMNS = ["PERMNO", "PERMCO"]
PRICE_NUMERIC_COLUMNS = ["DlyRet", "DlyPrc", "DlyVol", "ShrOut"]
PRICE_TARGET_COL = "target_crsp_excess_return_3m"
RETURN_FLOOR = -0.999999
# (rows in the trailing window, minimum observations)
TRAILING_WINDOWS = [(3, 2), (6, 3), (12, 6)]
FORWARD_WINDOW = 3

# Columns of the monthly price table carried into the link.
PRICE_LINK_COLUMNS = [
    "cusip8", "month_end", "PERMNO", "permco", "crsp_ticker", "primary_exch", "share_type",
    "crsp_obs_days", "crsp_ret_1m", "crsp_ret_3m", "crsp_ret_6m", "crsp_ret_12m",
    "crsp_vol_1m", "crsp_avg_volume_1m", "crsp_avg_dollar_volume_1m", "crsp_price_last",
    "crsp_market_cap_last", "market_return_fwd_3m", "target_crsp_return_3m", PRICE_TARGET_COL,
]
PRICE_NUMERIC_FEATURES = [
    "crsp_obs_days", "crsp_ret_1m", "crsp_ret_3m", "crsp_ret_6m", "crsp_ret_12m",
    "crsp_vol_1m", "crsp_avg_volume_1m", "crsp_avg_dollar_volume_1m", "crsp_price_last",
    "crsp_market_cap_last",
]
PRICE_CATEGORICAL_FEATURES = ["primary_exch", "share_type"]
