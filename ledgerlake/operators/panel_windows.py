"""Entity-time window features of the quarterly panel.

All of them use ONE window spec (entity, ordered by date), so Spark plans a
single Exchange + Sort + Window for the lot. Frames are row-based, as in the
reference: a missing quarter does not break a frame.

Group size: after key dedupe an entity holds at most one row per distinct
period date, so a window partition is bounded by the calendar (a few hundred
quarter ends), never by table size.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from ledgerlake.constants import DATE_COL, ENTITY_KEY, NEXT_GAP_MAX_DAYS, NEXT_GAP_MIN_DAYS
from ledgerlake.functions import days_between, stable_growth


def entity_window(entity: str = ENTITY_KEY, date: str = DATE_COL):
    return Window.partitionBy(entity).orderBy(date)


def previous_in_year(col: str, w=None, date: str = DATE_COL) -> Column:
    """Value of the previous row of the entity if it lies in the same calendar
    year, else missing — the (entity, year) group shift expressed on the shared
    entity window."""
    w = w or entity_window()
    same_year = F.year(F.lag(date, 1).over(w)) == F.year(F.col(date))
    return F.when(same_year, F.lag(col, 1).over(w))


def ytd_to_quarter(col: str, present: bool, w=None, floor_zero: bool = False) -> Column:
    """Year-to-date → quarterly difference; the YTD value itself when the
    previous in-year value is missing (W1). Column absent → all missing."""
    if not present:
        return F.lit(None).cast("double")
    prev = previous_in_year(col, w)
    q = F.when(prev.isNull(), F.col(col)).otherwise(F.col(col) - prev)
    if floor_zero:
        q = F.when(q < 0, None).otherwise(q)
    return q


def growth_qoq(col: str, w=None) -> Column:
    """Growth over the previous row of the entity, no gap check."""
    w = w or entity_window()
    return stable_growth(F.col(col), F.lag(col, 1).over(w))


def days_to_next(w=None, date: str = DATE_COL) -> Column:
    w = w or entity_window()
    return days_between(F.lead(date, 1).over(w), F.col(date))


def next_row_growth(col: str, w=None) -> Column:
    """Growth to the next row, kept only when the next row is 45–190 days
    ahead (W3)."""
    w = w or entity_window()
    gap = days_to_next(w)
    valid = gap.between(NEXT_GAP_MIN_DAYS, NEXT_GAP_MAX_DAYS)
    return F.when(valid, stable_growth(F.lead(col, 1).over(w), F.col(col)))
