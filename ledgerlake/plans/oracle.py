"""DuckDB oracle SQL, one statement per registered query.

Written independently of the Spark code path (different formulations where
possible: row_number dedupes instead of max_by, per-(entity, year) windows
instead of the shared entity window, row_number split cuts instead of a
sorted date array), over the same fixture views. Each query is a WITH chain
of the stage CTEs it needs, so every oracle statement runs stand-alone on
the raw driver tables.
"""

from __future__ import annotations

from ledgerlake.sources.fixtures import duckdb_ctes

D = 6  # decimals kept on computed doubles, both engines


def R(x: str, d: int = D) -> str:
    scale = f"{float(10 ** d)!r}"
    return f"(floor(({x}) * {scale} + 0.5) / {scale})"


def cs(x: str) -> str:
    t = f"upper(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'))"
    return f"CASE WHEN {t} IN ('', 'NAN', 'NONE', 'NULL', '<NA>') THEN NULL ELSE {t} END"


def fin(x: str) -> str:
    return f"CASE WHEN isfinite({x}) THEN {x} END"


def sd(n: str, d: str) -> str:
    return fin(f"(CASE WHEN abs({d}) > 1e-9 THEN ({n}) / ({d}) END)")


def sg(c: str, p: str) -> str:
    return fin(f"(({c}) - ({p})) / (abs({p}) + 1.0)")


NUMS = ["sic", "saleq", "cogsq", "niq", "atq", "ltq", "actq", "lctq", "dlttq", "xsgaq",
        "oibdpq", "rstcheq", "rstcheltq", "oancfy", "capxy", "qn"]
STRS = ["costat", "curcdq", "cusip", "gvkey"]
ALL_TYPED = STRS + ["datadate"] + NUMS + ["gvkey_str"]
STOCK = ["actq", "atq", "dlttq", "lctq", "ltq", "rstcheq", "rstcheltq"]
FLOW = ["saleq", "cogsq", "xsgaq", "capxy"]
CORE = ["actq", "atq", "cogsq", "dlttq", "lctq", "ltq", "niq", "oibdpq", "saleq", "xsgaq",
        "capxy", "oancfy", "rstcheq"]

_key = "NULLIF(regexp_extract({g}, '\\d+'), '')"


def _entity_key(g: str) -> str:
    k = _key.format(g=g)
    return f"CASE WHEN length({k}) >= 6 THEN {k} ELSE lpad({k}, 6, '0') END"


def typed_cte(src: str = "panel_q_raw", name: str = "q_typed") -> str:
    cols = [f"{cs(c)} AS {c}" for c in STRS] + ["TRY_CAST(datadate AS DATE) AS datadate"]
    cols += [f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in NUMS]
    cols.append(f"{_entity_key(cs('gvkey'))} AS gvkey_str")
    return f"{name} AS (SELECT {', '.join(cols)} FROM {src})"


def _nn() -> str:
    return " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in ALL_TYPED)


QUARTER_CTES = {
    "q_typed": typed_cte(),
    "q_clean0": "q_clean0 AS (SELECT * FROM q_typed WHERE gvkey_str IS NOT NULL AND datadate IS NOT NULL)",
    "q_dedup": (
        "q_dedup AS (SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY gvkey_str, datadate "
        f"ORDER BY ({_nn()}) DESC, {', '.join(c + ' NULLS FIRST' for c in ALL_TYPED)}) AS _rn FROM q_clean0) WHERE _rn = 1)"
    ),
    "q_inv": (
        "q_inv AS (SELECT * REPLACE ("
        + ", ".join(f"CASE WHEN {c} < 0 THEN NULL ELSE {c} END AS {c}" for c in STOCK + FLOW)
        + ") FROM q_dedup)"
    ),
    "q_w": (
        "q_w AS (SELECT *, "
        "lag(oancfy) OVER wy AS _p_oancfy, lag(capxy) OVER wy AS _p_capxy, "
        "lag(saleq) OVER w AS _p_saleq, lag(niq) OVER w AS _p_niq, lag(atq) OVER w AS _p_atq, "
        "lead(datadate) OVER w AS _n_date, lead(niq) OVER w AS _n_niq, lead(saleq) OVER w AS _n_saleq "
        "FROM q_inv WINDOW w AS (PARTITION BY gvkey_str ORDER BY datadate), "
        "wy AS (PARTITION BY gvkey_str, year(datadate) ORDER BY datadate))"
    ),
    "q_w2": (
        "q_w2 AS (SELECT *, "
        "CASE WHEN _p_oancfy IS NULL THEN oancfy ELSE oancfy - _p_oancfy END AS oancfq_approx, "
        "CASE WHEN (CASE WHEN _p_capxy IS NULL THEN capxy ELSE capxy - _p_capxy END) < 0 THEN NULL "
        "ELSE (CASE WHEN _p_capxy IS NULL THEN capxy ELSE capxy - _p_capxy END) END AS capxq_approx, "
        "CAST(date_diff('day', datadate, _n_date) AS INTEGER) AS days_to_next_observation "
        "FROM q_w)"
    ),
    "q_eng": (
        "q_eng AS (SELECT * EXCLUDE (_p_oancfy, _p_capxy, _p_saleq, _p_niq, _p_atq, _n_date, _n_niq, _n_saleq), "
        "CAST(year(datadate) AS INTEGER) AS calendar_year, 'Q' || CAST(quarter(datadate) AS VARCHAR) AS calendar_quarter, "
        "CAST(month(datadate) AS INTEGER) AS calendar_month, CAST(month(datadate) = 12 AS INTEGER) AS is_calendar_year_end, "
        "CASE WHEN sic IS NULL THEN NULL WHEN length(CAST(CAST(floor(sic / 100.0) AS BIGINT) AS VARCHAR)) >= 2 "
        "THEN CAST(CAST(floor(sic / 100.0) AS BIGINT) AS VARCHAR) "
        "ELSE lpad(CAST(CAST(floor(sic / 100.0) AS BIGINT) AS VARCHAR), 2, '0') END AS sic2, "
        "CASE WHEN sic IS NULL THEN 'Unknown' "
        "WHEN trunc(sic) BETWEEN 100 AND 999 THEN 'Agriculture' WHEN trunc(sic) BETWEEN 1000 AND 1499 THEN 'Mining' "
        "WHEN trunc(sic) BETWEEN 1500 AND 1799 THEN 'Construction' WHEN trunc(sic) BETWEEN 2000 AND 3999 THEN 'Manufacturing' "
        "WHEN trunc(sic) BETWEEN 4000 AND 4999 THEN 'Transportation' WHEN trunc(sic) BETWEEN 5000 AND 5199 THEN 'Wholesale' "
        "WHEN trunc(sic) BETWEEN 5200 AND 5999 THEN 'Retail' WHEN trunc(sic) BETWEEN 6000 AND 6799 THEN 'Finance' "
        "WHEN trunc(sic) BETWEEN 7000 AND 8999 THEN 'Services' WHEN trunc(sic) BETWEEN 9100 AND 9729 THEN 'Public Administration' "
        "ELSE 'Other' END AS sic_division, "
        "atq - ltq AS book_equity_proxy, ln(1 + CASE WHEN atq < 0 THEN 0 ELSE atq END) AS log_assets, "
        f"{sd('ltq', 'atq')} AS liabilities_to_assets, {sd('dlttq', 'atq')} AS debt_to_assets, "
        f"{sd('atq - ltq', 'atq')} AS equity_to_assets, {sd('actq', 'lctq')} AS current_ratio, "
        f"{sd('rstcheq', 'atq')} AS cash_like_to_assets, {sd('niq', 'atq')} AS roa, "
        f"{sd('niq', 'atq - ltq')} AS roe_proxy, {sd('niq', 'saleq')} AS profit_margin, "
        f"{sd('oibdpq', 'saleq')} AS ebitda_margin, {sd('saleq - cogsq', 'saleq')} AS gross_margin, "
        f"{sd('xsgaq', 'saleq')} AS sgna_to_sales, {sd('saleq', 'atq')} AS asset_turnover, "
        f"{sd('oancfq_approx', 'atq')} AS operating_cf_to_assets, {sd('capxq_approx', 'atq')} AS capex_to_assets, "
        + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}_missing" for c in CORE) + ", "
        f"{sg('saleq', '_p_saleq')} AS sales_growth_qoq, {sg('niq', '_p_niq')} AS niq_growth_qoq, "
        f"{sg('atq', '_p_atq')} AS asset_growth_qoq, _n_niq AS target_next_niq, "
        f"CASE WHEN days_to_next_observation BETWEEN 45 AND 190 THEN {sg('_n_niq', 'niq')} END AS target_next_niq_growth, "
        f"CASE WHEN days_to_next_observation BETWEEN 45 AND 190 THEN {sg('_n_saleq', 'saleq')} END AS target_next_sale_growth "
        "FROM q_w2)"
    ),
    "q_eng2": (
        "q_eng2 AS (SELECT *, CAST(target_next_niq_growth > 0 AS INTEGER) AS target_earnings_growth_positive FROM q_eng)"
    ),
    "q_model": "q_model AS (SELECT * FROM q_eng2 WHERE target_next_niq_growth IS NOT NULL)",
    "q_dates": (
        "q_dates AS (SELECT datadate, row_number() OVER (ORDER BY datadate) AS rn, count(*) OVER () AS n "
        "FROM (SELECT DISTINCT datadate FROM q_model))"
    ),
    "q_cuts": (
        "q_cuts AS (SELECT max(CASE WHEN rn = ti THEN datadate END) AS train_end_date, "
        "max(CASE WHEN rn = vi THEN datadate END) AS validation_end_date FROM (SELECT *, "
        "CASE WHEN CAST(floor(n * 0.7::DOUBLE) AS BIGINT) = 0 THEN n ELSE CAST(floor(n * 0.7::DOUBLE) AS BIGINT) END AS ti, "
        "CASE WHEN CAST(floor(n * 0.85::DOUBLE) AS BIGINT) = 0 THEN n ELSE CAST(floor(n * 0.85::DOUBLE) AS BIGINT) END AS vi "
        "FROM q_dates))"
    ),
    "q_split": (
        "q_split AS (SELECT m.*, CASE WHEN m.datadate <= c.train_end_date THEN 'train' "
        "WHEN m.datadate <= c.validation_end_date THEN 'validation' ELSE 'test' END AS split "
        "FROM q_model m CROSS JOIN q_cuts c)"
    ),
}

QUARTER_ORDER = list(QUARTER_CTES)


def with_chain(upto: str, body: str, extra: dict | None = None) -> str:
    """WITH <fixtures>, <stage CTEs up to `upto`>[, extra] <body>."""
    names = QUARTER_ORDER[: QUARTER_ORDER.index(upto) + 1] if upto else []
    parts = [duckdb_ctes()] + [QUARTER_CTES[n] for n in names]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v})")
    return "WITH " + ",\n".join(parts) + "\n" + body


NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
RAW_COLS = ["gvkey", "datadate", "sic", "costat", "curcdq", "cusip", "saleq", "cogsq", "niq", "atq", "ltq",
            "actq", "lctq", "dlttq", "xsgaq", "oibdpq", "rstcheq", "rstcheltq", "oancfy", "capxy", "qn"]


def _na(x: str) -> str:
    toks = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)
    return f"CASE WHEN {x} IN ({toks}) THEN NULL ELSE {x} END"


def _digits_key(x: str, width: int) -> str:
    return f"CASE WHEN length({x}) >= {width} THEN {x} ELSE lpad({x}, {width}, '0') END"


PRICE_CTES = {
    "p_typed": (
        "p_typed AS (SELECT *, abs(DlyPrc) AS price_abs, abs(DlyPrc) * ShrOut AS market_cap, "
        "abs(DlyPrc) * DlyVol AS dollar_volume, last_day(DlyCalDt) AS month_end, "
        "1.0 + CASE WHEN DlyRet < -0.999999 THEN -0.999999 ELSE DlyRet END AS ret_plus, "
        f"substr({_digits_key('NULLIF(regexp_extract(HdrCUSIP, ' + chr(39) + '[A-Z0-9]+' + chr(39) + '), ' + chr(39) + chr(39) + ')', 8)}, 1, 8) AS cusip8 "
        "FROM (SELECT TRY_CAST(PERMNO AS INTEGER) AS PERMNO, TRY_CAST(PERMCO AS INTEGER) AS PERMCO, "
        f"{cs('HdrCUSIP')} AS HdrCUSIP, {cs('PrimaryExch')} AS PrimaryExch, {cs('ShareType')} AS ShareType, "
        f"{cs('Ticker')} AS Ticker, TRY_CAST(DlyCalDt AS DATE) AS DlyCalDt, TRY_CAST(DlyPrc AS DOUBLE) AS DlyPrc, "
        "TRY_CAST(DlyRet AS DOUBLE) AS DlyRet, TRY_CAST(DlyVol AS DOUBLE) AS DlyVol, TRY_CAST(ShrOut AS DOUBLE) AS ShrOut "
        "FROM panel_d))"
    ),
    "p_clean": ("p_clean AS (SELECT * FROM p_typed WHERE PERMNO IS NOT NULL AND DlyCalDt IS NOT NULL "
                "AND cusip8 IS NOT NULL AND month_end IS NOT NULL)"),
    "p_monthly0": (
        "p_monthly0 AS (SELECT PERMNO, month_end, "
        + ", ".join(f"arg_max({src}, DlyCalDt) FILTER (WHERE {src} IS NOT NULL) AS {dst}" for src, dst in [
            ("cusip8", "cusip8"), ("Ticker", "crsp_ticker"), ("PERMCO", "permco"), ("PrimaryExch", "primary_exch"),
            ("ShareType", "share_type"), ("price_abs", "crsp_price_last"), ("market_cap", "crsp_market_cap_last")])
        + ", CAST(count(DlyRet) AS BIGINT) AS crsp_obs_days, "
        "CASE WHEN count(DlyRet) > 0 THEN product(ret_plus) - 1.0 END AS crsp_ret_1m, "
        "stddev_samp(DlyRet) AS crsp_vol_1m, avg(DlyVol) AS crsp_avg_volume_1m, "
        "avg(dollar_volume) AS crsp_avg_dollar_volume_1m, max(DlyCalDt) AS crsp_date_last "
        "FROM p_clean GROUP BY PERMNO, month_end)"
    ),
    "p_monthly": ("p_monthly AS (SELECT *, ln(1 + CASE WHEN crsp_ret_1m < -0.999999 THEN -0.999999 "
                  "ELSE crsp_ret_1m END) AS crsp_log_ret_1m FROM p_monthly0)"),
    "p_win": (
        "p_win AS (SELECT *, "
        + ", ".join(
            f"CASE WHEN count(crsp_log_ret_1m) OVER (PARTITION BY PERMNO ORDER BY month_end ROWS BETWEEN {n - 1} "
            f"PRECEDING AND CURRENT ROW) >= {m} THEN exp(sum(crsp_log_ret_1m) OVER (PARTITION BY PERMNO ORDER BY "
            f"month_end ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)) - 1 END AS crsp_ret_{n}m"
            for n, m in [(3, 2), (6, 3), (12, 6)])
        + ", CASE WHEN lead(crsp_log_ret_1m, 1) OVER w IS NOT NULL AND lead(crsp_log_ret_1m, 2) OVER w IS NOT NULL "
        "AND lead(crsp_log_ret_1m, 3) OVER w IS NOT NULL THEN exp(lead(crsp_log_ret_1m, 1) OVER w + "
        "lead(crsp_log_ret_1m, 2) OVER w + lead(crsp_log_ret_1m, 3) OVER w) - 1 END AS target_crsp_return_3m "
        "FROM p_monthly WINDOW w AS (PARTITION BY PERMNO ORDER BY month_end))"
    ),
    "p_market": "p_market AS (SELECT month_end, avg(crsp_ret_1m) AS market_ret_1m FROM p_monthly GROUP BY month_end)",
    "p_market1": ("p_market1 AS (SELECT *, ln(1 + CASE WHEN market_ret_1m < -0.999999 THEN -0.999999 "
                  "ELSE market_ret_1m END) AS market_log_ret_1m FROM p_market)"),
    "p_market2": (
        "p_market2 AS (SELECT *, CASE WHEN lead(market_log_ret_1m, 1) OVER w IS NOT NULL AND "
        "lead(market_log_ret_1m, 2) OVER w IS NOT NULL AND lead(market_log_ret_1m, 3) OVER w IS NOT NULL THEN "
        "exp(lead(market_log_ret_1m, 1) OVER w + lead(market_log_ret_1m, 2) OVER w + lead(market_log_ret_1m, 3) OVER w) - 1 "
        "END AS market_return_fwd_3m FROM p_market1 WINDOW w AS (ORDER BY month_end))"
    ),
    "p_joined": (
        "p_joined AS (SELECT w.*, m.market_return_fwd_3m, w.target_crsp_return_3m - m.market_return_fwd_3m "
        "AS target_crsp_excess_return_3m FROM p_win w LEFT JOIN p_market2 m ON w.month_end = m.month_end)"
    ),
    "p_final": (
        "p_final AS (SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY cusip8, month_end "
        "ORDER BY crsp_market_cap_last DESC NULLS FIRST, PERMNO DESC) AS _rn FROM p_joined) WHERE _rn = 1)"
    ),
    "l_panel": (
        "l_panel AS (SELECT *, substr(upper(regexp_replace(cusip, '^\\s+|\\s+$', '', 'g')), 1, 8) AS cusip8, "
        "last_day(datadate) AS month_end FROM q_eng2)"
    ),
    "l_merged": (
        "l_merged AS (SELECT l.*, p.PERMNO, p.permco, p.crsp_ticker, p.primary_exch, p.share_type, p.crsp_obs_days, "
        "p.crsp_ret_1m, p.crsp_ret_3m, p.crsp_ret_6m, p.crsp_ret_12m, p.crsp_vol_1m, p.crsp_avg_volume_1m, "
        "p.crsp_avg_dollar_volume_1m, p.crsp_price_last, p.crsp_market_cap_last, p.market_return_fwd_3m, "
        "p.target_crsp_return_3m, p.target_crsp_excess_return_3m "
        "FROM l_panel l LEFT JOIN p_final p ON l.cusip8 = p.cusip8 AND l.month_end = p.month_end)"
    ),
    "l_model": "l_model AS (SELECT * FROM l_merged WHERE target_crsp_excess_return_3m IS NOT NULL)",
    "l_dates": ("l_dates AS (SELECT datadate, row_number() OVER (ORDER BY datadate) AS rn, count(*) OVER () AS n "
                "FROM (SELECT DISTINCT datadate FROM l_model))"),
    "l_cuts": QUARTER_CTES["q_cuts"].replace("q_cuts AS", "l_cuts AS").replace("FROM q_dates", "FROM l_dates"),
    "l_split": (
        "l_split AS (SELECT m.*, CASE WHEN m.datadate <= c.train_end_date THEN 'train' "
        "WHEN m.datadate <= c.validation_end_date THEN 'validation' ELSE 'test' END AS crsp_split "
        "FROM l_model m CROSS JOIN l_cuts c)"
    ),
}

CLUSTER = ["log_assets", "liabilities_to_assets", "debt_to_assets", "equity_to_assets", "current_ratio", "roa",
           "profit_margin", "ebitda_margin", "gross_margin", "asset_turnover", "operating_cf_to_assets",
           "capex_to_assets", "sales_growth_qoq", "asset_growth_qoq"]
EPS10 = 10 * 2.220446049250313e-16


CATEGORIES = ["costat", "curcdq", "sic2", "sic_division", "calendar_quarter"]
PRICE_NUMBERS = [
    "actq", "atq", "cogsq", "dlttq", "lctq", "ltq", "niq", "oibdpq", "saleq", "xsgaq", "capxq_approx", "oancfq_approx",
    "calendar_year", "calendar_month", "is_calendar_year_end", "book_equity_proxy", "log_assets", "liabilities_to_assets",
    "debt_to_assets", "equity_to_assets", "current_ratio", "cash_like_to_assets", "roa", "roe_proxy", "profit_margin",
    "ebitda_margin", "gross_margin", "sgna_to_sales", "asset_turnover", "operating_cf_to_assets", "capex_to_assets",
    "sales_growth_qoq", "niq_growth_qoq", "asset_growth_qoq", *[f"{c}_missing" for c in CORE],
    "crsp_obs_days", "crsp_ret_1m", "crsp_ret_3m", "crsp_ret_6m", "crsp_ret_12m", "crsp_vol_1m", "crsp_avg_volume_1m",
    "crsp_avg_dollar_volume_1m", "crsp_price_last", "crsp_market_cap_last"]


def _levels(src: str, cols: list[str]) -> str:
    """The level table of some categorical columns of `src`."""
    long = " UNION ALL ".join(f"SELECT '{c}' AS feature, coalesce({c}, 'Unknown') AS level FROM {src}" for c in cols)
    return (
        "SELECT feature, level, train_count, CASE WHEN train_count >= 20 THEN level ELSE '__infrequent__' END "
        "AS encoded_level, CAST(CASE WHEN train_count >= 20 THEN row_number() OVER (PARTITION BY feature ORDER BY "
        "CASE WHEN train_count >= 20 THEN 0 ELSE 1 END, level) - 1 ELSE count_if(train_count >= 20) OVER "
        "(PARTITION BY feature) END AS INTEGER) AS slot "
        f"FROM (SELECT feature, level, count(*) AS train_count FROM ({long}) GROUP BY feature, level)")


def _clip(x: str, lo: str, hi: str) -> str:
    return f"CASE WHEN {x} < {lo} THEN {lo} WHEN {x} > {hi} THEN {hi} ELSE {x} END"


PREP_CTES = {
    "m_train": "m_train AS (SELECT * FROM q_split WHERE split = 'train')",
    "m_med": "m_med AS (SELECT " + ", ".join(f"coalesce(median({c}), 0.0) AS {c}" for c in CLUSTER) + " FROM m_train)",
    "m_imp": ("m_imp AS (SELECT " + ", ".join(f"coalesce(t.{c}, m.{c}) AS {c}" for c in CLUSTER)
              + " FROM m_train t CROSS JOIN m_med m)"),
    "m_q": "m_q AS (SELECT " + ", ".join(f"quantile_cont({c}, [0.01, 0.99]) AS {c}" for c in CLUSTER) + " FROM m_imp)",
    "m_clip": ("m_clip AS (SELECT " + ", ".join(f"{_clip('i.' + c, 'q.' + c + '[1]', 'q.' + c + '[2]')} AS {c}" for c in CLUSTER)
               + " FROM m_imp i CROSS JOIN m_q q)"),
    "m_mom": ("m_mom AS (SELECT " + ", ".join(f"avg({c}) AS {c}_mean, stddev_pop({c}) AS {c}_std" for c in CLUSTER)
              + " FROM m_clip)"),
}

ALL_CTES = {**QUARTER_CTES, **PRICE_CTES, **PREP_CTES}


def chain(*names: str, body: str) -> str:
    """WITH <fixtures>, <every stage CTE up to the last one named> <body>."""
    order = list(ALL_CTES)
    last = max(order.index(n) for n in names) if names else -1
    parts = [duckdb_ctes()] + [ALL_CTES[n] for n in order[: last + 1]]
    return "WITH " + ",\n".join(parts) + "\n" + body


def sel(cols_plain, cols_round=(), src="", d=D, where=""):
    items = list(cols_plain) + [f"{R(c, d)} AS {c}" for c in cols_round]
    return f"SELECT {', '.join(items)} FROM {src}" + (f" WHERE {where}" if where else "")


KEY = ["gvkey_str", "datadate"]
MKEY = ["PERMNO", "month_end"]
RATIOS = ["book_equity_proxy", "log_assets", "liabilities_to_assets", "debt_to_assets", "equity_to_assets",
          "current_ratio", "cash_like_to_assets", "roa", "roe_proxy", "profit_margin", "ebitda_margin",
          "gross_margin", "sgna_to_sales", "asset_turnover", "operating_cf_to_assets", "capex_to_assets"]
ENG_DTYPES_SQL = "CASE {t} WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date' " \
                 "WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' ELSE lower({t}) END"
CORR = ["log_assets", "liabilities_to_assets", "debt_to_assets", "current_ratio", "roa", "profit_margin",
        "ebitda_margin", "gross_margin", "asset_turnover", "sales_growth_qoq", "asset_growth_qoq",
        "target_next_niq_growth"]


def _eng_columns() -> list[str]:
    flags = [f"{c}_missing" for c in CORE]
    return (RAW_COLS + ["gvkey_str", "calendar_year", "calendar_quarter", "calendar_month", "is_calendar_year_end",
                        "sic2", "sic_division", "oancfq_approx", "capxq_approx"] + RATIOS + flags
            + ["sales_growth_qoq", "niq_growth_qoq", "asset_growth_qoq", "days_to_next_observation",
               "target_next_niq", "target_next_niq_growth", "target_next_sale_growth",
               "target_earnings_growth_positive"])


def _missingness_body(src: str, cols: list[str], extra: str = "") -> str:
    items = ", ".join(
        f"{{'column': '{c}', 'missing_count': CAST(count_if({c} IS NULL) AS BIGINT), "
        f"'missing_pct': count_if({c} IS NULL) / count(*), 'dtype': {ENG_DTYPES_SQL.format(t=f'first(typeof({c}))')}}}"
        for c in cols)
    return f"SELECT unnest([{items}], recursive := true) FROM {src}{extra}"


def _typed_all(src_cte: str) -> list[str]:
    return ["gvkey", "datadate", "costat", "curcdq", "cusip", "gvkey_str"], NUMS


def _split_summary(src: str, label: str, target: str, security: bool) -> str:
    perm = "count(DISTINCT PERMNO) AS permnos, " if security else ""
    return (f"SELECT {label}, count(*) AS rows, count(DISTINCT gvkey_str) AS companies, {perm}"
            "strftime(min(datadate), '%Y-%m-%d') AS start_date, strftime(max(datadate), '%Y-%m-%d') AS end_date, "
            f"{R(f'avg({target})')} AS target_mean, {R(f'median({target})')} AS target_median "
            f"FROM {src} GROUP BY {label}")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    text_cols = ", ".join(f"{_na(f'CAST({c} AS VARCHAR)')} AS {c}" for c in RAW_COLS)
    text_cte = f"q_text AS (SELECT {text_cols} FROM panel_q_raw)"
    typed_text = typed_cte("q_text", "q_typed_text")
    q["scan_quarterly"] = chain("q_typed", body=(
        f", {text_cte}, {typed_text}\n"
        + sel(["gvkey", "datadate", "costat", "curcdq", "cusip", "gvkey_str"], NUMS, "q_typed_text",
              where="gvkey_str IS NOT NULL AND datadate IS NOT NULL"))).replace("\n, q_text", ",\nq_text", 1)
    q["coerce_numeric"] = chain("q_typed", body=(
        f", {text_cte}, {typed_text}\n" + sel(["gvkey", "datadate", "gvkey_str"], NUMS, "q_typed_text")
    )).replace("\n, q_text", ",\nq_text", 1)
    q["scan_daily"] = chain("p_typed", body=sel(
        ["PERMNO", "PERMCO", "HdrCUSIP", "PrimaryExch", "ShareType", "Ticker", "DlyCalDt"],
        ["DlyPrc", "DlyRet", "DlyVol", "ShrOut"], "p_typed"))
    q["clean_strings"] = chain("q_typed", body=sel(["gvkey_str", "datadate", "gvkey", "costat", "curcdq", "cusip"],
                                                   src="q_typed"))
    q["parse_dates"] = chain(body=(
        "SELECT gvkey, CAST(datadate AS VARCHAR) AS datadate_text, "
        "TRY_CAST(CAST(datadate AS VARCHAR) AS DATE) AS datadate FROM panel_q_raw"))
    q["entity_key"] = chain("q_typed", body=sel(["gvkey", "gvkey_str"], src="q_typed"))
    q["drop_bad_keys"] = chain("q_typed", body=(
        "SELECT count(*) AS typed_rows, CAST(count_if(datadate IS NULL) AS BIGINT) AS invalid_datadate_rows, "
        "CAST(count_if(gvkey_str IS NULL) AS BIGINT) AS missing_gvkey_rows, "
        "CAST(count_if(datadate IS NULL OR gvkey_str IS NULL) AS BIGINT) AS rows_dropped_bad_key_or_date FROM q_typed"))
    q["invalid_to_null"] = chain("q_inv", body=sel(KEY, STOCK + FLOW, "q_inv"))
    q["calendar_features"] = chain("q_eng2", body=sel(
        KEY + ["calendar_year", "calendar_quarter", "calendar_month", "is_calendar_year_end"], src="q_eng2"))
    q["sic2"] = chain("q_eng2", body=sel(KEY + ["sic2"], ["sic"], "q_eng2"))
    q["sic_division"] = chain("q_eng2", body=sel(KEY + ["sic_division"], ["sic"], "q_eng2"))
    q["financial_ratios"] = chain("q_eng2", body=sel(KEY, RATIOS, "q_eng2"))
    q["missing_flags"] = chain("q_eng2", body=sel(KEY + [f"{c}_missing" for c in CORE], src="q_eng2"))
    q["categorical_clean"] = chain("q_eng2", body=sel(
        KEY + [f"coalesce({c}, 'Unknown') AS {c}" for c in ["costat", "curcdq", "sic2", "sic_division",
                                                            "calendar_quarter"]], src="q_eng2"))
    q["model_rows"] = chain("q_model", body=sel(KEY, ["target_next_niq_growth"], "q_model"))
    q["drop_bad_price_keys"] = chain("p_clean", body=(
        "SELECT count(*) AS crsp_raw_rows, CAST(count_if(PERMNO IS NULL OR DlyCalDt IS NULL OR cusip8 IS NULL "
        "OR month_end IS NULL) AS BIGINT) AS crsp_rows_dropped_bad_key_or_date, "
        "(SELECT strftime(min(DlyCalDt), '%Y-%m-%d') FROM p_clean) AS crsp_min_date, "
        "(SELECT strftime(max(DlyCalDt), '%Y-%m-%d') FROM p_clean) AS crsp_max_date, "
        "(SELECT count(DISTINCT PERMNO) FROM p_clean) AS crsp_unique_permnos, "
        "(SELECT count(DISTINCT cusip8) FROM p_clean) AS crsp_unique_cusip8 FROM p_typed"))
    q["cusip8_panel"] = chain("l_panel", body=sel(KEY + ["cusip", "cusip8", "month_end"], src="l_panel"))
    q["cusip8_price"] = chain("p_typed", body=sel(["PERMNO", "DlyCalDt", "HdrCUSIP", "cusip8"], src="p_typed"))
    q["price_scalars"] = chain("p_typed", body=sel(
        ["PERMNO", "DlyCalDt", "month_end"], ["price_abs", "market_cap", "dollar_volume", "ret_plus"], "p_typed", d=4))
    # dedupe
    q["dedupe_exact"] = chain("q_clean0", body=(
        "SELECT DISTINCT " + ", ".join(["gvkey", "datadate", "costat", "curcdq", "cusip", "gvkey_str"]
                                       + [f"{R(c)} AS {c}" for c in NUMS]) + " FROM q_clean0"))
    q["dup_key_metrics"] = chain("q_clean0", body=(
        "SELECT (SELECT count(*) FROM q_clean0) - (SELECT count(*) FROM (SELECT DISTINCT * FROM q_clean0)) "
        "AS exact_duplicate_rows, CAST(sum(c - 1) AS BIGINT) AS duplicate_key_rows_before_resolution, "
        "CAST(count_if(c > 1) AS BIGINT) AS duplicate_key_groups_before_resolution, "
        "count(*) AS rows_after_duplicate_resolution "
        "FROM (SELECT gvkey_str, datadate, count(*) AS c FROM (SELECT DISTINCT * FROM q_clean0) GROUP BY ALL)"))
    q["dedupe_most_complete"] = chain("q_dedup", body=sel(
        ["gvkey", "datadate", "costat", "curcdq", "cusip", "gvkey_str"], NUMS, "q_dedup"))
    q["dedupe_cusip_month"] = chain("p_final", body=sel(
        ["cusip8", "month_end", "PERMNO"], ["crsp_market_cap_last", "crsp_ret_1m", "target_crsp_excess_return_3m"],
        "p_final", d=4))
    # windows
    q["ytd_to_quarter"] = chain("q_eng2", body=sel(KEY, ["oancfy", "capxy", "oancfq_approx", "capxq_approx"], "q_eng2"))
    q["growth_qoq"] = chain("q_eng2", body=sel(KEY, ["sales_growth_qoq", "niq_growth_qoq", "asset_growth_qoq"], "q_eng2"))
    q["next_quarter_target"] = chain("q_eng2", body=sel(
        KEY + ["days_to_next_observation", "target_earnings_growth_positive"],
        ["target_next_niq", "target_next_niq_growth", "target_next_sale_growth"], "q_eng2"))
    q["daily_to_monthly"] = chain("p_monthly", body=sel(
        MKEY + ["cusip8", "crsp_ticker", "permco", "primary_exch", "share_type", "crsp_obs_days", "crsp_date_last"],
        ["crsp_ret_1m", "crsp_vol_1m", "crsp_avg_volume_1m", "crsp_avg_dollar_volume_1m", "crsp_price_last",
         "crsp_market_cap_last", "crsp_log_ret_1m"], "p_monthly", d=4))
    q["trailing_returns"] = chain("p_win", body=sel(MKEY, ["crsp_ret_3m", "crsp_ret_6m", "crsp_ret_12m"], "p_win"))
    q["forward_returns"] = chain("p_win", body=sel(MKEY, ["target_crsp_return_3m"], "p_win"))
    q["market_mean"] = chain("p_market", body=sel(["month_end"], ["market_ret_1m"], "p_market"))
    q["market_forward"] = chain("p_market2", body=sel(["month_end"], ["market_return_fwd_3m"], "p_market2"))
    q["market_join"] = chain("p_joined", body=sel(MKEY, ["market_return_fwd_3m"], "p_joined"))
    q["excess_return_target"] = chain("p_joined", body=sel(
        MKEY, ["target_crsp_return_3m", "market_return_fwd_3m", "target_crsp_excess_return_3m"], "p_joined"))
    # joins
    q["panel_price_join"] = chain("l_merged", body=sel(
        KEY + ["cusip8", "month_end", "PERMNO", "permco", "crsp_ticker", "primary_exch", "share_type", "crsp_obs_days"],
        ["crsp_ret_1m", "crsp_ret_3m", "crsp_ret_12m", "crsp_price_last", "target_crsp_excess_return_3m"],
        "l_merged", d=4))
    q["write_back"] = chain("q_split", body=(
        "SELECT e.gvkey_str, e.datadate, s.split FROM q_eng2 e LEFT JOIN q_split s "
        "ON e.gvkey_str = s.gvkey_str AND e.datadate = s.datadate"))
    # profiles
    q["panel_profile"] = chain("q_eng2", body=(
        f"SELECT count(*) AS cleaned_rows, {len(_eng_columns())} AS cleaned_columns, "
        "strftime(min(datadate), '%Y-%m-%d') AS min_date, strftime(max(datadate), '%Y-%m-%d') AS max_date, "
        "count(DISTINCT gvkey_str) AS unique_gvkeys, count(target_next_niq_growth) AS "
        "target_nonmissing_rows_before_split FROM q_eng2"))
    miss = _missingness_body("q_eng2", _eng_columns())
    q["missingness"] = chain("q_eng2", body=(
        f"SELECT \"column\", missing_count, {R('missing_pct')} AS missing_pct, dtype FROM ({miss})"))
    q["high_missing"] = chain("q_eng2", body=(
        f"SELECT \"column\", {R('missing_pct')} AS missing_pct FROM ({miss}) WHERE missing_pct > 0.9"))
    stock_flow = [(c, "balance_sheet_stock_must_be_nonnegative") for c in STOCK] + \
                 [(c, "nonnegative_accounting_flow_set_to_missing") for c in FLOW]
    items = ", ".join(f"{{'column': '{c}', 'rule': '{r}', 'invalid_count': CAST(count_if({c} < 0) AS BIGINT)}}"
                      for c, r in stock_flow)
    q["invalid_audit"] = chain("q_dedup", body=f"SELECT unnest([{items}], recursive := true) FROM q_dedup")
    pairs = [(a, b) for i, a in enumerate(CORR) for b in CORR[i + 1:]]
    items = ", ".join(f"{{'feature_a': '{a}', 'feature_b': '{b}', 'corr': CASE WHEN covar_pop({a}, {b}) IS NULL OR stddev_pop(CASE WHEN {b} IS NOT NULL THEN {a} END) * stddev_pop(CASE WHEN {a} IS NOT NULL THEN {b} END) = 0 THEN NULL ELSE corr({a}, {b}) END}}" for a, b in pairs)
    q["feature_correlations"] = chain("q_model", body=(
        f"SELECT feature_a, feature_b, {R('corr')} AS corr FROM (SELECT unnest([{items}], recursive := true) FROM q_model)"))
    wb_cols = _eng_columns() + ["split", "finance_cluster", "cluster_pca1", "cluster_pca2"]
    wb_src = ("(SELECT e.*, s.split, CASE WHEN s.split IS NULL THEN NULL ELSE 'c' END AS finance_cluster, "
              "CASE WHEN s.split IS NULL THEN NULL ELSE 0.0 END AS cluster_pca1, "
              "CASE WHEN s.split IS NULL THEN NULL ELSE 0.0 END AS cluster_pca2 FROM q_eng2 e LEFT JOIN q_split s "
              "ON e.gvkey_str = s.gvkey_str AND e.datadate = s.datadate)")
    q["missingness_top20"] = chain("q_split", body=(
        f"SELECT \"column\", {R('missing_pct * 100')} AS missing_pct FROM ({_missingness_body(wb_src, wb_cols)}) "
        "ORDER BY missing_pct DESC, \"column\" ASC LIMIT 20"))
    q["price_profile"] = chain("p_final", body=(
        "SELECT count(*) AS crsp_raw_rows, CAST(count_if(PERMNO IS NULL OR DlyCalDt IS NULL OR cusip8 IS NULL "
        "OR month_end IS NULL) AS BIGINT) AS crsp_rows_dropped_bad_key_or_date, "
        "(SELECT strftime(min(DlyCalDt), '%Y-%m-%d') FROM p_clean) AS crsp_min_date, "
        "(SELECT strftime(max(DlyCalDt), '%Y-%m-%d') FROM p_clean) AS crsp_max_date, "
        "(SELECT count(DISTINCT PERMNO) FROM p_clean) AS crsp_unique_permnos, "
        "(SELECT count(DISTINCT cusip8) FROM p_clean) AS crsp_unique_cusip8, "
        "(SELECT count(*) FROM p_joined) AS crsp_monthly_rows_before_cusip_dedupe, "
        "(SELECT count(*) FROM p_joined) - (SELECT count(*) FROM p_final) AS crsp_duplicate_cusip_month_rows, "
        "(SELECT count(*) FROM p_final) AS crsp_monthly_rows, "
        "(SELECT count(target_crsp_excess_return_3m) FROM p_final) AS crsp_target_nonmissing_rows FROM p_typed"))
    q["merge_profile"] = chain("l_split", body=(
        "SELECT count(*) AS merge_rows, count(PERMNO) AS merge_matched_rows, "
        "count(target_crsp_excess_return_3m) AS merge_model_rows, "
        "(SELECT CAST(count_if(crsp_split = 'train') AS BIGINT) FROM l_split) AS crsp_train_rows, "
        "(SELECT CAST(count_if(crsp_split = 'validation') AS BIGINT) FROM l_split) AS crsp_validation_rows, "
        "(SELECT CAST(count_if(crsp_split = 'test') AS BIGINT) FROM l_split) AS crsp_test_rows FROM l_merged"))
    # split
    q["chronological_split"] = chain("q_split", body=sel(KEY + ["split"], src="q_split"))
    q["split_cuts"] = chain("q_cuts", body=(
        "SELECT strftime(train_end_date, '%Y-%m-%d') AS train_end_date, "
        "strftime(validation_end_date, '%Y-%m-%d') AS validation_end_date FROM q_cuts"))
    q["split_summary"] = chain("q_split", body=_split_summary("q_split", "split", "target_next_niq_growth", False))
    q["price_split"] = chain("l_split", body=sel(KEY + ["PERMNO", "crsp_split"], src="l_split"))
    q["price_split_summary"] = chain("l_split", body=_split_summary(
        "l_split", "crsp_split", "target_crsp_excess_return_3m", True))
    # preprocessing
    q["cluster_profile_by_quarter"] = chain("m_train", body=(
        "SELECT 'cluster_' || CAST(quarter(datadate) AS VARCHAR) AS finance_cluster, "
        + ", ".join(f"{R(f'round_even(median({c}), 4)')} AS {c}" for c in CLUSTER)
        + ", count(*) AS row_count FROM m_train GROUP BY quarter(datadate)"))
    q["impute_median"] = chain("m_med", body=" UNION ALL ".join(
        f"SELECT '{c}' AS feature, {R(c)} AS median FROM m_med" for c in CLUSTER))
    q["clip_quantiles"] = chain("m_q", body=" UNION ALL ".join(
        f"SELECT '{c}' AS feature, {R(c + '[1]')} AS lower, {R(c + '[2]')} AS upper FROM m_q" for c in CLUSTER))
    q["standard_scale"] = chain("m_mom", body=" UNION ALL ".join(
        f"SELECT '{c}' AS feature, {R(c + '_mean')} AS mean, "
        f"{R(f'CASE WHEN {c}_std < {EPS10!r} THEN 1.0 ELSE {c}_std END')} AS scale FROM m_mom" for c in CLUSTER))
    scaled = ", ".join(
        R(f"({_clip(f'coalesce(s.{c}, md.{c})', f'qq.{c}[1]', f'qq.{c}[2]')} - mo.{c}_mean) / "
          f"(CASE WHEN mo.{c}_std < {EPS10!r} THEN 1.0 ELSE mo.{c}_std END)", 4) + f" AS {c}" for c in CLUSTER)
    q["numeric_pipeline"] = chain("m_mom", body=(
        f"SELECT s.gvkey_str, s.datadate, {scaled} FROM q_split s CROSS JOIN m_med md CROSS JOIN m_q qq "
        "CROSS JOIN m_mom mo"))
    std = ", ".join(f"(c.{c} - mo.{c}_mean) / (CASE WHEN mo.{c}_std < {EPS10!r} THEN 1.0 ELSE mo.{c}_std END) AS {c}" for c in CLUSTER)
    pairs = ", ".join(f"{{'feature_a': '{a}', 'feature_b': '{b}', 'covariance': {R(f'covar_samp({a}, {b})')}}}"
                      for i, a in enumerate(CLUSTER) for b in CLUSTER[i:])
    q["pca_covariance"] = chain("m_mom", body=(
        f"SELECT unnest([{pairs}], recursive := true) FROM (SELECT {std} FROM m_clip c CROSS JOIN m_mom mo)"))
    q["one_hot_levels"] = chain("m_train", body=_levels("m_train", CATEGORIES))
    coded = ", ".join(f"{c}.encoded_level AS {c}_level, {c}.slot AS {c}_slot" for c in CATEGORIES)
    joins = " ".join(f"LEFT JOIN lv {c} ON {c}.feature = '{c}' AND {c}.level = coalesce(s.{c}, 'Unknown')" for c in CATEGORIES)
    q["one_hot_rows"] = chain("m_train", body=(
        f"SELECT s.gvkey_str, s.datadate, {coded} FROM q_split s {joins}")).replace(
            "\nSELECT s.gvkey_str", f",\nlv AS ({_levels('m_train', CATEGORIES)})\nSELECT s.gvkey_str")
    price = "lt AS (SELECT * FROM l_split WHERE crsp_split = 'train')"
    q["price_one_hot_levels"] = chain("l_split", body=_levels(
        "(SELECT * FROM l_split WHERE crsp_split = 'train')", [*CATEGORIES, "primary_exch", "share_type"]))
    values = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM lt" for c in PRICE_NUMBERS)
    q["price_numeric_params"] = chain("l_split", body="SELECT feature").replace("\nSELECT feature", f""",
{price},
lx AS ({values}),
lm AS (SELECT feature, coalesce(median(x), 0.0) AS m FROM lx GROUP BY feature),
li AS (SELECT feature, m, coalesce(x, m) AS x FROM lx JOIN lm USING (feature)),
lq AS (SELECT feature, quantile_cont(x, 0.01) AS lo, quantile_cont(x, 0.99) AS hi FROM li GROUP BY feature),
lc AS (SELECT feature, m, lo, hi, {_clip('x', 'lo', 'hi')} AS x FROM li JOIN lq USING (feature))
SELECT feature, {R('any_value(m)', 4)} AS median, {R('any_value(lo)', 4)} AS lower, {R('any_value(hi)', 4)} AS upper,
       {R('avg(x)', 4)} AS mean, {R(f'CASE WHEN stddev_pop(x) < {EPS10!r} THEN 1.0 ELSE stddev_pop(x) END', 4)} AS scale
FROM lc GROUP BY feature""")
    # The same panels through CSV files.
    q |= {f"{name}_csv": q[name] for name in ("scan_quarterly", "scan_daily")}
    return q
