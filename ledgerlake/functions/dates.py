"""Date column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c, dtype: str = "string", fmt: str = DATE_FORMAT) -> Column:
    """Text → DATE with a pinned format, bad values → null.

    Typed inputs (date / timestamp) are simply cast."""
    if dtype == "string":
        return F.try_to_date(_col(c), fmt)
    return _col(c).cast("date")


def month_end(c) -> Column:
    """Last calendar day of the month."""
    return F.last_day(_col(c))


def calendar_quarter(c) -> Column:
    return F.concat(F.lit("Q"), F.quarter(_col(c)).cast("string"))


def days_between(later, earlier) -> Column:
    return F.datediff(_col(later), _col(earlier))


def date_string(c) -> Column:
    return F.date_format(_col(c), DATE_FORMAT)
