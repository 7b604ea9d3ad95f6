"""Daily prices → monthly return features.

Scale notes
-----------
* Daily → monthly is one aggregation on (security, month) (sort-based: the
  "last value" buffers hold strings) with
  map-side partial aggregation: no daily sort, and a hot (security, month)
  group — e.g. a third of all rows being copies of one security-month — is
  combined on the map side before the shuffle.
* Trailing / forward returns are windows over ONE security's months: the
  window partition is bounded by the number of months in the data, not by
  table size.
* The market series has one row per month (bounded by the calendar span),
  so its forward window runs unpartitioned and it is broadcast into the
  join with the monthly table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.constants import (
    FORWARD_WINDOW,
    PRICE_INT_COLUMNS,
    PRICE_NUMERIC_COLUMNS,
    PRICE_STRING_COLUMNS,
    PRICE_TARGET_COL,
    RETURN_FLOOR,
    TRAILING_WINDOWS,
)
from ledgerlake.functions import (
    clean_string,
    clip_lower,
    month_end,
    parse_date,
    price_link_key,
    to_double,
)
from ledgerlake.operators.standardize import ROW_ORDER

SECURITY = "PERMNO"
DAY = "DlyCalDt"


def _to_int(name: str, dtype: str) -> Column:
    c = F.col(name)
    if dtype == "string":
        return F.trim(c).try_cast("int")
    return c.cast("int")


def type_daily(df: DataFrame) -> DataFrame:
    """Typed, cleaned daily rows with the price scalars.

    Columns outside the 11 required ones are pruned (and never read)."""
    dtypes = dict(df.dtypes)
    keep = [F.col(ROW_ORDER)] if ROW_ORDER in df.columns else []
    cols = {}
    for c in PRICE_INT_COLUMNS:
        cols[c] = _to_int(c, dtypes[c])
    for c in PRICE_STRING_COLUMNS:
        cols[c] = clean_string(c)
    cols[DAY] = parse_date(DAY, dtypes[DAY])
    for c in PRICE_NUMERIC_COLUMNS:
        cols[c] = to_double(c, dtypes[c])
    typed = df.select(*keep, *[e.alias(k) for k, e in cols.items()])
    return typed.select("*", *[e.alias(k) for k, e in price_scalars().items()])


def price_scalars() -> dict:
    price_abs = F.abs(F.col("DlyPrc"))
    return {
        "cusip8": price_link_key("HdrCUSIP"),
        "price_abs": price_abs,
        "market_cap": price_abs * F.col("ShrOut"),
        "dollar_volume": price_abs * F.col("DlyVol"),
        "month_end": month_end(DAY),
        "ret_plus": F.lit(1.0) + clip_lower("DlyRet", RETURN_FLOOR),
    }


def drop_bad_price_keys(daily: DataFrame) -> DataFrame:
    """Drop rows with a missing security, day, link key or month."""
    return daily.na.drop(subset=[SECURITY, DAY, "cusip8", "month_end"])


def daily_profile(daily_typed: DataFrame) -> DataFrame:
    """Counts of the price scan (part of A12). The daily rows are aggregated once,
    by (security, link key); the distinct counts come from those keys."""
    good = (F.col(SECURITY).isNotNull() & F.col(DAY).isNotNull() & F.col("cusip8").isNotNull()
            & F.col("month_end").isNotNull())
    keys = daily_typed.groupBy(F.when(good, F.col(SECURITY)).alias("s"), F.when(good, F.col("cusip8")).alias("c")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(good, F.col(DAY))).alias("first"), F.max(F.when(good, F.col(DAY))).alias("last"))
    return keys.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("crsp_raw_rows"),
        # Bad rows share the key without a security.
        F.coalesce(F.sum(F.when(F.col("s").isNull(), F.col("n"))), F.lit(0)).alias("crsp_rows_dropped_bad_key_or_date"),
        F.min("first").alias("crsp_min_date"),
        F.max("last").alias("crsp_max_date"),
        F.count_distinct("s").alias("crsp_unique_permnos"),
        F.count_distinct("c").alias("crsp_unique_cusip8"),
    )


def _last_non_null(c: str, order: Column) -> Column:
    """Value of the latest row (by `order`) where `c` is not missing."""
    return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order))


def daily_to_monthly(daily: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per (security, month): last known identifiers and prices,
    observation count, compounded return, volatility, average volumes (A5).

    "Last" follows the day; rows sharing a security-day are ordered by file
    position when the scan recorded it, else by a 64-bit hash of their values
    — deterministic, fixed-width (small aggregation buffers), and only a hash
    collision between two different rows of one security-day could leave
    their order open."""
    value_cols = [c for c in daily.columns if c != ROW_ORDER and c not in extra_keys]
    tie = F.col(ROW_ORDER) if ROW_ORDER in daily.columns else F.xxhash64(*[F.col(c) for c in value_cols])
    # The tie-break is a column of its own, so that a row is hashed once and not once for each aggregate.
    daily = daily.withColumn("_tie", tie)
    order = F.struct(F.col(DAY), F.col("_tie"))
    monthly = daily.groupBy(SECURITY, "month_end", *extra_keys).agg(
        _last_non_null("cusip8", order).alias("cusip8"),
        _last_non_null("Ticker", order).alias("crsp_ticker"),
        _last_non_null("PERMCO", order).alias("permco"),
        _last_non_null("PrimaryExch", order).alias("primary_exch"),
        _last_non_null("ShareType", order).alias("share_type"),
        F.count("DlyRet").alias("crsp_obs_days"),
        F.product("ret_plus").alias("_growth"),
        F.stddev_samp("DlyRet").alias("crsp_vol_1m"),
        F.avg("DlyVol").alias("crsp_avg_volume_1m"),
        F.avg("dollar_volume").alias("crsp_avg_dollar_volume_1m"),
        _last_non_null("price_abs", order).alias("crsp_price_last"),
        _last_non_null("market_cap", order).alias("crsp_market_cap_last"),
        F.max(DAY).alias("crsp_date_last"),
    )
    ret = F.when(F.col("crsp_obs_days") > 0, F.col("_growth")) - F.lit(1.0)
    return (monthly.withColumn("crsp_ret_1m", ret).drop("_growth")
            .withColumn("crsp_log_ret_1m", F.log1p(clip_lower("crsp_ret_1m", RETURN_FLOOR))))


def _security_window():
    return Window.partitionBy(SECURITY).orderBy("month_end")


def trailing_sum(col: str, rows: int, min_obs: int, w=None) -> Column:
    """Sum over the current and previous rows-1 rows, when at least
    `min_obs` of them are present (rolling sum with min_periods)."""
    frame = (w or _security_window()).rowsBetween(-(rows - 1), 0)
    return F.when(F.count(col).over(frame) >= min_obs, F.sum(col).over(frame))


def forward_sum(col: str, rows: int = FORWARD_WINDOW, w=None) -> Column:
    """Sum over the next `rows` rows (t+1 … t+rows), all of them required."""
    frame = (w or _security_window()).rowsBetween(1, rows)
    return F.when(F.count(col).over(frame) == rows, F.sum(col).over(frame))


def trailing_and_forward_returns(monthly: DataFrame) -> DataFrame:
    """Trailing 3/6/12-month compounded returns and the forward 3-month
    return of each security (W4, W5): one Window operator."""
    w = _security_window()
    cols = {f"crsp_ret_{n}m": F.expm1(trailing_sum("crsp_log_ret_1m", n, m, w)) for n, m in TRAILING_WINDOWS}
    cols["target_crsp_return_3m"] = F.expm1(forward_sum("crsp_log_ret_1m", FORWARD_WINDOW, w))
    return monthly.withColumns(cols)


def market_series(monthly: DataFrame) -> DataFrame:
    """Equal-weight market return per month over all securities (A6) and its
    forward 3-month compounded return (W6). One row per month: the
    unpartitioned window runs on at most (months in the data) rows."""
    market = monthly.groupBy("month_end").agg(F.avg("crsp_ret_1m").alias("market_ret_1m"))
    market = market.withColumn("market_log_ret_1m", F.log1p(clip_lower("market_ret_1m", RETURN_FLOOR)))
    w = Window.orderBy("month_end")
    return market.withColumn("market_return_fwd_3m",
                             F.expm1(forward_sum("market_log_ret_1m", FORWARD_WINDOW, w)))


def join_market(monthly: DataFrame, market: DataFrame) -> DataFrame:
    """Left join of the monthly table with the market series on month
    and the excess-return target (W7). The market side is one row per month,
    a calendar-bounded size, so it is broadcast."""
    m = F.broadcast(market.select("month_end", "market_return_fwd_3m"))
    out = monthly.join(m, "month_end", "left")
    return out.withColumn(PRICE_TARGET_COL, F.col("target_crsp_return_3m") - F.col("market_return_fwd_3m"))


def monthly_aggregates(daily_typed: DataFrame) -> DataFrame:
    """Typed daily rows → one row per (security, month): the frame that
    `monthly_returns` reads twice. Stage it (persist it or write it as a
    table) in between, and the daily rows are read and aggregated once."""
    return daily_to_monthly(drop_bad_price_keys(daily_typed))


def monthly_returns(monthly: DataFrame) -> DataFrame:
    """Monthly aggregates → trailing/forward returns, market series and the
    excess-return target. `monthly` is read twice (windows and market
    average): pass a staged frame or written table to avoid recomputing the daily pass."""
    return join_market(trailing_and_forward_returns(monthly), market_series(monthly))
