"""Numeric column functions with pandas-style missing-value rules.

Missing is always SQL null; NaN and infinities are turned into null at the
points where the reproduced pipeline treats them as missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.constants import SAFE_DIVIDE_MIN_ABS

# A plain decimal or scientific number, optional sign, optional padding, or an
# infinity / NaN spelling. Rejects Java-only suffixes such as "1d" and "1f" and
# thousands separators, which a pandas numeric coercion rejects as well.
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    x = _col(c)
    return F.when(~F.isnan(x), x)


def finite_or_null(c) -> Column:
    """±Inf and NaN become null."""
    x = _col(c)
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def coerce_numeric(c) -> Column:
    """Text → double, unparseable → null, NaN → null; ±Inf is kept."""
    s = _col(c).cast("string")
    ok = s.rlike(NUMBER_PATTERN)
    return nan_to_null(F.when(ok, F.trim(s).try_cast("double")))


def to_double(c, dtype: str) -> Column:
    """Coerce a column of any input type to a nullable double."""
    if dtype == "string":
        return coerce_numeric(c)
    if dtype in ("double", "float"):
        return nan_to_null(_col(c).cast("double"))
    return _col(c).cast("double")


def clip_lower(c, lower: float) -> Column:
    """Null-preserving lower clip (pandas `clip(lower=)`); greatest() would
    turn null into the bound."""
    x = _col(c)
    return F.when(x < F.lit(lower), F.lit(lower)).otherwise(x)


def clip(c, lower: Column, upper: Column) -> Column:
    """Null-preserving two-sided clip."""
    x = _col(c)
    return F.when(x < lower, lower).when(x > upper, upper).otherwise(x)


def safe_divide(num, den, min_abs: float = SAFE_DIVIDE_MIN_ABS) -> Column:
    """num / den, null when |den| <= min_abs or missing, non-finite → null."""
    n, d = _col(num), _col(den)
    return finite_or_null(F.when(F.abs(d) > F.lit(min_abs), n / d))


def stable_growth(current, previous) -> Column:
    """(cur − prev) / (|prev| + 1), non-finite → null."""
    cur, prev = _col(current), _col(previous)
    return finite_or_null((cur - prev) / (F.abs(prev) + F.lit(1.0)))


def positive_flag(c) -> Column:
    """1 when > 0, 0 otherwise, null when missing."""
    return (_col(c) > 0).cast("int")


def missing_flag(c) -> Column:
    """1 when missing, else 0."""
    return _col(c).isNull().cast("int")
