"""Flow C: daily prices → monthly features → link with the quarterly panel.

Shuffles: one aggregation on (security, month) with map-side partials; one
exchange on security for the trailing/forward windows; a calendar-bounded
market aggregate broadcast back; one aggregation on (cusip8, month) for the
dedupe; one join exchange on (cusip8, month) for the link.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.constants import PRICE_TARGET_COL
from ledgerlake.operators.dedupe import dedupe_cusip_month
from ledgerlake.operators.link import link_prices
from ledgerlake.operators.prices import monthly_aggregates, monthly_returns, type_daily
from ledgerlake.operators.split import chronological_split


def monthly_prices(raw_daily: DataFrame, prefer_known_cap: bool = False,
                   stage: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Monthly price table, one row per (cusip8, month_end). `stage` receives
    the monthly aggregates, which are read twice, and returns the frame to go on
    with: e.g. persisted, or written as a table and read back."""
    return dedupe_cusip_month(monthly_returns(stage(monthly_aggregates(type_daily(raw_daily)))), prefer_known_cap)


def linked_panel(panel: DataFrame, monthly_final: DataFrame) -> DataFrame:
    return link_prices(panel, monthly_final)


def price_model_frame(merged: DataFrame) -> DataFrame:
    """Linked rows with the excess-return target, split on their own dates."""
    model = merged.where(F.col(PRICE_TARGET_COL).isNotNull())
    return chronological_split(model, "datadate", "crsp_split")
