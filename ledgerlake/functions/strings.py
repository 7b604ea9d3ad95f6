"""String column functions: cleaning, key extraction, zero padding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.constants import CLEANED_NULL_TOKENS, CSV_NA_TOKENS

# Whitespace removed at both ends (Spark's one-argument trim() only removes
# spaces).
_WHITESPACE = " \t\n\x0b\x0c\r"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove leading and trailing whitespace (space, tab, newline, vertical
    tab, form feed, carriage return) — a character-set trim, no regex."""
    return F.btrim(_col(c).cast("string"), F.lit(_WHITESPACE))


def clean_string(c) -> Column:
    """Trim, upper-case, and map the empty/placeholder spellings to null."""
    up = F.upper(strip(c))
    return F.when(~up.isin(*CLEANED_NULL_TOKENS), up)


def csv_missing_to_null(c) -> Column:
    """Null out the raw CSV fields a default pandas reader treats as missing."""
    raw = _col(c)
    return F.when(~raw.isin(*CSV_NA_TOKENS), raw)


def first_match(c, pattern: str) -> Column:
    """First substring matching `pattern`, null when nothing matches."""
    return F.regexp_substr(_col(c).cast("string"), F.lit(pattern))


def zfill(c, width: int) -> Column:
    """Left-pad with zeros to `width` without ever truncating, keeping a
    leading sign in front of the zeros (Python str.zfill semantics)."""
    s = _col(c)
    signed = s.startswith("-") | s.startswith("+")
    padded_signed = F.concat(F.substring(s, 1, 1), F.lpad(F.substring(s, 2, 1 << 30), width - 1, "0"))
    return (
        F.when(s.isNull(), None)
        .when(F.length(s) >= width, s)
        .when(signed, padded_signed)
        .otherwise(F.lpad(s, width, "0"))
    )


def pad_zeros(c, width: int) -> Column:
    """Left-pad an unsigned token with zeros to `width`, never truncating."""
    s = _col(c)
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def _first_run(c, pattern: str) -> Column:
    """First match of `pattern` (a plain run, no groups); null when none.
    regexp_extract is evaluated once and its empty result mapped to null."""
    return F.nullif(F.regexp_extract(_col(c).cast("string"), f"({pattern})", 1), F.lit(""))


def entity_key(c, width: int = 6) -> Column:
    """First run of digits, zero-padded to `width`."""
    return pad_zeros(_first_run(c, r"\d+"), width)


def price_link_key(c) -> Column:
    """Price-side link key: first alphanumeric run, zero-padded to 8, first 8.

    Expects an already cleaned (trimmed, upper-cased) identifier."""
    return F.substring(pad_zeros(_first_run(c, "[A-Z0-9]+"), 8), 1, 8)


def panel_link_key(c) -> Column:
    """Panel-side link key: trim, upper-case, first 8 characters.

    No extraction or padding: deliberately asymmetric to `price_link_key`."""
    return F.substring(F.upper(strip(c)), 1, 8)


def categorical_clean(c, missing: str = "Unknown") -> Column:
    """Categorical input: missing becomes `missing`, everything a string."""
    return F.coalesce(_col(c).cast("string"), F.lit(missing))
