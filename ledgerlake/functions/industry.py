"""Industry classification from SIC codes, as native CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.constants import SIC_DIVISIONS, SIC_OTHER, SIC_UNKNOWN
from ledgerlake.functions.strings import zfill


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sic2(c) -> Column:
    """Two-digit industry: floor(sic / 100), zero-padded to 2.

    Missing stays missing (it only becomes "Unknown" in the categorical
    cleaner later)."""
    return zfill(F.floor(_col(c) / F.lit(100.0)).cast("string"), 2)


def sic_division(c) -> Column:
    """Broad SIC division (P10); the value is truncated toward zero first."""
    sic = _col(c)
    code = sic.try_cast("long")  # truncation toward zero, as int() does; an infinite code has no division
    expr = F.when(sic.isNull(), F.lit(SIC_UNKNOWN))
    for lo, hi, name in SIC_DIVISIONS:
        expr = expr.when(code.between(lo, hi), F.lit(name))
    return expr.otherwise(F.lit(SIC_OTHER))
