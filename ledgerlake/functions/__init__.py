"""Column → Column functions (all native Spark expressions, no UDFs)."""

from ledgerlake.functions.dates import (
    calendar_quarter,
    date_string,
    days_between,
    month_end,
    parse_date,
)
from ledgerlake.functions.industry import sic2, sic_division
from ledgerlake.functions.numeric import (
    clip,
    clip_lower,
    coerce_numeric,
    finite_or_null,
    missing_flag,
    nan_to_null,
    positive_flag,
    safe_divide,
    stable_growth,
    to_double,
)
from ledgerlake.functions.strings import (
    categorical_clean,
    clean_string,
    csv_missing_to_null,
    entity_key,
    first_match,
    panel_link_key,
    price_link_key,
    strip,
    zfill,
)

__all__ = [
    "calendar_quarter", "date_string", "days_between", "month_end", "parse_date",
    "sic2", "sic_division",
    "clip", "clip_lower", "coerce_numeric", "finite_or_null", "missing_flag",
    "nan_to_null", "positive_flag", "safe_divide", "stable_growth", "to_double",
    "categorical_clean", "clean_string", "csv_missing_to_null", "entity_key",
    "first_match", "panel_link_key", "price_link_key", "strip", "zfill",
]
