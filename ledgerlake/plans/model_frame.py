"""Flow B: model frame → cluster features, fitted preprocessors, write-back."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.constants import TARGET_COL
from ledgerlake.operators.features import feature_columns
from ledgerlake.operators.prep import InfrequentOneHot, NumericPrep, feature_assembler
from ledgerlake.operators.split import split_cuts, split_label
from ledgerlake.operators.unsupervised import (
    ClusterArtifacts,
    add_cluster_features,
    fit_cluster_features,
)

CLUSTER_OUTPUTS = ["split", "finance_cluster", "cluster_pca1", "cluster_pca2"]


def train_rows(model: DataFrame, label: str = "split") -> DataFrame:
    return model.where(F.col(label) == "train")


def fit_clusters(model: DataFrame, restarts: int | None = None, exact: bool = True) -> tuple[DataFrame, ClusterArtifacts]:
    """Fit PCA / k-means on the training rows; label every model row."""
    _, _, cluster_cols = feature_columns(model.columns)
    kw = {"restarts": restarts} if restarts else {}
    art = fit_cluster_features(train_rows(model), cluster_cols, exact=exact, **kw)
    return add_cluster_features(model, art), art


def fit_preprocessor(train: DataFrame, numeric: list[str], categorical: list[str],
                     exact: bool = True) -> PipelineModel:
    """Numeric pipeline + infrequent-pooled one-hot + assembler, fitted on
    training rows only (M4–M6, M9)."""
    num = NumericPrep(inputCols=numeric, outputCols=[f"__n_{c}" for c in numeric], exact=exact).fit(train)
    cat = InfrequentOneHot(inputCols=categorical, outputCols=[f"__c_{c}" for c in categorical]).fit(train)
    asm = feature_assembler([f"__n_{c}" for c in numeric], [f"__c_{c}" for c in categorical])
    return PipelineModel(stages=[num, cat, asm])


def write_back(engineered: DataFrame, art: ClusterArtifacts | None = None,
               target: str = TARGET_COL, panel: DataFrame | None = None) -> DataFrame:
    """Split label (and cluster features) on the full panel; rows without a
    target get missing values (J3). Computed in place as conditional columns
    of each row — the model rows are a filter of the same frame, so no join
    back is needed. The cut dates are those of `panel` where `engineered` holds a part of its rows."""
    has_target = F.col(target).isNotNull()
    cuts = split_cuts((engineered if panel is None else panel).where(has_target)).select(
        F.struct("train_end_date", "validation_end_date")).scalar()
    out = engineered.withColumn("split", F.when(has_target, split_label(F.col("datadate"), cuts)))
    if art is not None:
        out = add_cluster_features(out, art, only_where=has_target)
    return out
