"""Sinks (K1–K4): partitioned tables, gzip CSV, JSON profiles, fitted models.

Splits are written ONCE, partitioned by the split label (not one scan per
split). Audit tables are tiny (one row per column / rule / cluster) and are
written as a single file.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators.unsupervised import ClusterArtifacts


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Main sink: parquet (zstd/snappy per session default)."""
    df.write.mode("overwrite").format(fmt).save(path)


def write_partitioned_splits(df: DataFrame, path: str, label: str = "split", fmt: str = "parquet") -> None:
    """train / validation / test in one pass, one folder per label (K1)."""
    df.write.mode("overwrite").partitionBy(label).format(fmt).save(path)


def write_csv_gz(df: DataFrame, path: str) -> None:
    """gzip-compressed CSV with a header (K1)."""
    df.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)


def write_audit_csv(df: DataFrame, path: str) -> None:
    """Small audit table as one plain CSV file (K2)."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_profile_json(df: DataFrame, path: str) -> None:
    """Profile metrics as JSON lines (K3)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    """Fitted preprocessing pipeline (K4); reload with PipelineModel.load."""
    model.write().overwrite().save(path)


def save_clusters(spark: SparkSession, art: ClusterArtifacts, path: str) -> None:
    """Everything that labels new rows (K4): the fitted preprocessor, and as JSON
    the feature list, loadings, centres and costs."""
    save_model(PipelineModel([art.prep]), f"{path}/models")
    values = {k: v for k, v in vars(art).items() if k != "prep"}
    spark.createDataFrame([(json.dumps(values),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/values")


def load_clusters(spark: SparkSession, path: str) -> ClusterArtifacts:
    (prep,) = PipelineModel.load(f"{path}/models").stages
    values = json.loads(spark.read.text(f"{path}/values").first()["value"])
    return ClusterArtifacts(prep=prep, **values)
