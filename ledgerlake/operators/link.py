"""Panel ↔ price link and write-back.

The link is a left equi-join on (cusip8, month_end). The price side is
unique per key after the cusip-month dedupe, so the join never fans out and
the output has exactly the panel's rows. Panel rows without a link key get a
unique salted key that can never match a price key (it starts with a NUL
character) and hashes evenly, so they neither pile up in one reducer nor
need a second pass over the panel; AQE's skew-join handling splits a hot
non-null key on the panel side, and AQE broadcasts the price side only when
its measured size is below the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.constants import DATE_COL, PRICE_LINK_COLUMNS
from ledgerlake.functions import month_end, panel_link_key

LINK_KEYS = ["cusip8", "month_end"]
_JOIN_KEY = "__link_key"


def add_link_keys(panel: DataFrame, cusip: str = "cusip", date: str = DATE_COL) -> DataFrame:
    return panel.withColumns({"cusip8": panel_link_key(cusip), "month_end": month_end(date)})


def link_prices(panel: DataFrame, monthly: DataFrame) -> DataFrame:
    """Panel ⟕ monthly prices on (cusip8, month_end)."""
    panel = add_link_keys(panel)
    # Deterministic salt from the panel's unique key (same value on a task
    # retry); falls back to every column when the key columns are absent.
    grain = [c for c in ("gvkey_str", DATE_COL) if c in panel.columns]
    grain = grain if len(grain) == 2 else panel.columns
    salt = F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(c) for c in grain]).cast("string"))
    left = panel.withColumn(_JOIN_KEY, F.coalesce(F.col("cusip8"), salt))
    right = (monthly.select([c for c in PRICE_LINK_COLUMNS if c in monthly.columns])
             .withColumnRenamed("cusip8", _JOIN_KEY))
    return left.join(right, [_JOIN_KEY, "month_end"], "left").drop(_JOIN_KEY)


def write_back(panel: DataFrame, labelled: DataFrame, cols: list[str],
               keys=("gvkey_str", DATE_COL)) -> DataFrame:
    """Attach columns computed on the model rows back onto the full panel by
    the unique key; other rows get missing values (J3)."""
    right = labelled.select(*keys, *cols)
    return panel.join(right, list(keys), "left")
