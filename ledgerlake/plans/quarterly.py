"""Flow A: raw quarterly panel → cleaned, engineered panel → model frame.

Shuffle budget of the flow: one aggregation on (entity, date) for the
dedupe (map-side combined, skew safe), one exchange on entity for all window
features, one tiny aggregate of distinct dates for the split cuts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlake.constants import DATE_COL
from ledgerlake.operators.dedupe import dedupe_most_complete
from ledgerlake.operators.features import engineer_features, model_rows
from ledgerlake.operators.invalid import treat_invalid_values
from ledgerlake.operators.split import chronological_split
from ledgerlake.operators.standardize import standardize_quarterly


def cleaned_panel(raw: DataFrame) -> DataFrame:
    """Typed, key-deduplicated panel with impossible values treated."""
    return treat_invalid_values(dedupe_most_complete(standardize_quarterly(raw)))


def engineered_panel(raw: DataFrame) -> DataFrame:
    return engineer_features(cleaned_panel(raw))


def model_frame(engineered: DataFrame) -> DataFrame:
    """Rows with a target, labelled train / validation / test by date."""
    return chronological_split(model_rows(engineered), DATE_COL, "split")
