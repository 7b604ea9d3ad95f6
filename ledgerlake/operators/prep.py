"""Leakage-free feature preprocessing fitted on the training split (M1–M6, M9).

Numeric pipeline: exact median imputation (an all-missing column imputes 0)
→ clipping at the training 1 % / 99 % quantiles of the imputed values
(linear interpolation) → standard scaling with the population standard
deviation (a constant column is divided by 1).

The fits depend on each other (quantiles of imputed values, moments of
clipped values): medians and quantiles come from one radix selection over the training
rows, the moments from one aggregate that uses them as literals. Each returns a
few numbers per feature. The pyspark.ml estimators below persist those values
with the standard ML writers.

Quantiles: `exact=True` (default) finds exact order statistics with
state independent of the rows (`operators/quantiles.py`); `exact=False` uses
`percentile_approx` (rank error 1/accuracy, one pass for each fit).
"""

from __future__ import annotations

import json

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.param.shared import HasInputCols, HasOutputCols, Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.constants import (
    CATEGORY_MISSING,
    CLIP_LOWER,
    CLIP_UPPER,
    INFREQUENT_LEVEL,
    MIN_CATEGORY_FREQUENCY,
)
from ledgerlake.functions import categorical_clean, clip
from ledgerlake.operators.quantiles import imputed_quantiles
from ledgerlake.session import ensure_checkpoint_dir

EPS = 2.220446049250313e-16  # float64 machine epsilon
APPROX_ACCURACY = 100000


class NumericParams:
    """Fitted parameters of the numeric pipeline.

    A few passes over the training rows, each returning a handful of
    numbers per feature; the next pass uses them as literals, so every plan
    stays small and every expression compiles into whole-stage codegen."""

    def __init__(self, train: DataFrame, cols: list[str], lower: float = CLIP_LOWER,
                 upper: float = CLIP_UPPER, exact: bool = True):
        self.cols = list(cols)
        # Several passes over the same rows: keep the projected training columns
        # (MEMORY_AND_DISK, recomputable from lineage if an executor is lost).
        cached = train.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if cached.isEmpty():
                raise ValueError("the training part has no rows to fit on")
            if exact:
                found = imputed_quantiles(cached, cols, [lower, upper])
                self.median = {c: found[c][0] for c in cols}
                q = {c: found[c][1] for c in cols}
            else:
                med = cached.agg(*[F.percentile_approx(c, 0.5, APPROX_ACCURACY).alias(c) for c in cols]).first()
                self.median = {c: (0.0 if med[c] is None else float(med[c])) for c in cols}
                q = cached.agg(*[F.percentile_approx(self.imputed(c), [lower, upper], APPROX_ACCURACY).alias(c) for c in cols]).first()
            self.lower = {c: float(q[c][0]) for c in cols}
            self.upper = {c: float(q[c][1]) for c in cols}
            mom = cached.agg(*[F.avg(self.clipped(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                             *[F.stddev_pop(self.clipped(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        finally:
            cached.unpersist()
        self.mean = {c: float(mom[f"m{i}"]) for i, c in enumerate(cols)}
        self.scale = {c: _scale(mom[f"s{i}"]) for i, c in enumerate(cols)}

    def imputed(self, c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(self.median[c]))

    def clipped(self, c: str) -> Column:
        return clip(self.imputed(c), F.lit(self.lower[c]), F.lit(self.upper[c]))

    def scaled(self, c: str) -> Column:
        return (self.clipped(c) - F.lit(self.mean[c])) / F.lit(self.scale[c])

    def values(self) -> dict:
        return {k: [getattr(self, k)[c] for c in self.cols] for k in ("median", "lower", "upper", "mean", "scale")}

    def table(self, spark: SparkSession) -> DataFrame:
        """(feature, median, lower, upper, mean, scale): the fitted values, one row per feature."""
        rows = [(c, self.median[c], self.lower[c], self.upper[c], self.mean[c], self.scale[c]) for c in self.cols]
        return spark.createDataFrame(rows, "feature string, median double, lower double, upper double, mean double, scale double")


def _scale(std) -> float:
    """Population std, with (near) zero replaced by 1."""
    if std is None or std < 10 * EPS:
        return 1.0
    return float(std)


def numeric_params(train: DataFrame, cols: list[str], exact: bool = True) -> NumericParams:
    return NumericParams(train, cols, exact=exact)


def transform_numeric(df: DataFrame, params: NumericParams, suffix: str = "") -> DataFrame:
    """Replace (or add with `suffix`) the scaled numeric columns (M4)."""
    return df.withColumns({f"{c}{suffix}": params.scaled(c) for c in params.cols})


# --- pyspark.ml estimators (fit collects the bounded parameter row) ----------

class _PrepParams(HasInputCols, HasOutputCols):
    lower = Param(Params._dummy(), "lower", "lower clip quantile", TypeConverters.toFloat)
    upper = Param(Params._dummy(), "upper", "upper clip quantile", TypeConverters.toFloat)
    exact = Param(Params._dummy(), "exact", "exact quantiles", TypeConverters.toBoolean)


class NumericPrep(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Median impute → quantile clip → population-std scaling, fitted on the
    rows passed to `fit` only."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, lower=CLIP_LOWER, upper=CLIP_UPPER, exact=True):
        super().__init__()
        self._setDefault(lower=CLIP_LOWER, upper=CLIP_UPPER, exact=True)
        self._set(**self._input_kwargs)

    def _fit(self, train: DataFrame) -> NumericPrepModel:
        cols = self.getInputCols()
        p = NumericParams(train, cols, self.getOrDefault("lower"), self.getOrDefault("upper"),
                          self.getOrDefault("exact"))
        values = p.values()
        out = self.getOutputCols() if self.isSet("outputCols") else cols
        model = NumericPrepModel(inputCols=cols, outputCols=out, fitted=json.dumps(values))
        return model


class NumericPrepModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    fitted = Param(Params._dummy(), "fitted", "fitted parameters (JSON)", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, fitted=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def values(self) -> dict:
        return json.loads(self.getOrDefault("fitted"))

    def expressions(self) -> dict[str, Column]:
        v = self.values()
        out = {}
        for i, (c, o) in enumerate(zip(self.getInputCols(), self.getOutputCols())):
            x = F.coalesce(F.col(c), F.lit(v["median"][i]))
            x = clip(x, F.lit(v["lower"][i]), F.lit(v["upper"][i]))
            out[o] = (x - F.lit(v["mean"][i])) / F.lit(v["scale"][i])
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.expressions())


# --- categorical: infrequent pooling + one-hot (M5) ---------------------------

RARE_PARTS = 1024  # groups that a feature's rare levels are dealt to


def category_levels(train: DataFrame, cols: list[str], min_frequency: int = MIN_CATEGORY_FREQUENCY) -> DataFrame:
    """(feature, level, train_count, encoded_level, slot) per training level:
    levels seen fewer than `min_frequency` times share one infrequent slot
    placed after the frequent levels (sorted). One aggregate over an unpivot;
    only a feature's frequent levels, at most rows / min_frequency, are numbered in one window group."""
    long = train.select([categorical_clean(c, CATEGORY_MISSING).alias(c) for c in cols]) \
        .unpivot([], cols, "feature", "level")
    counts = long.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("train_count"))
    frequent = F.col("train_count") >= min_frequency
    part = F.when(frequent, F.lit(-1)).otherwise(F.pmod(F.xxhash64("level"), F.lit(RARE_PARTS)))
    w = Window.partitionBy("feature", "_part").orderBy("level")
    sizes = counts.groupBy("feature").agg(F.count_if(frequent).alias("n_frequent"))  # one row a column
    return counts.withColumn("_part", part).withColumn("_number", F.row_number().over(w)).join(F.broadcast(sizes), "feature").select(
        "feature", "level", "train_count",
        F.when(frequent, F.col("level")).otherwise(F.lit(INFREQUENT_LEVEL)).alias("encoded_level"),
        F.when(frequent, F.col("_number") - 1).otherwise(F.col("n_frequent")).cast("int").alias("slot"),
    )


def join_levels(df: DataFrame, levels: DataFrame, cols: list[str], prefix: str = "") -> DataFrame:
    """Adds `<prefix><col>_level` and `<col>_slot` of each column by a left join with its
    levels: missing where the level was not seen in training. A level occurs once a
    feature, so no row fans out. Spark broadcasts a level table that it measures below its
    threshold, and otherwise sorts and merges, splitting hot levels (adaptive skew join)."""
    for c in cols:
        key = f"__{c}_key"
        own = levels.where(F.col("feature") == c).select(
            F.col("level").alias(key), F.col("encoded_level").alias(f"{prefix}{c}_level"),
            F.col("slot").alias(f"{prefix}{c}_slot"))
        df = df.withColumn(key, categorical_clean(c, CATEGORY_MISSING)).join(own, key, "left").drop(key)
    return df


class InfrequentOneHot(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """One-hot encoding with infrequent-level pooling; unseen levels → all zeros."""

    minFrequency = Param(Params._dummy(), "minFrequency", "minimum training count", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, minFrequency=MIN_CATEGORY_FREQUENCY):
        super().__init__()
        self._setDefault(minFrequency=MIN_CATEGORY_FREQUENCY)
        self._set(**self._input_kwargs)

    def _fit(self, train: DataFrame) -> InfrequentOneHotModel:
        cols = self.getInputCols()
        ensure_checkpoint_dir(train.sparkSession)
        levels = category_levels(train, cols, self.getOrDefault("minFrequency")).checkpoint()
        sizes = {r["feature"]: int(r["slots"]) for r in
                 levels.groupBy("feature").agg((F.max("slot") + 1).alias("slots")).collect()}  # one row a column
        model = InfrequentOneHotModel(inputCols=cols, outputCols=self.getOutputCols(), sizes=json.dumps(sizes))
        model.levels = levels
        return model


class InfrequentOneHotModel(Model, HasInputCols, HasOutputCols, MLReadable, MLWritable):
    """The fitted level table stays a table: it is joined, and saved as Parquet."""

    sizes = Param(Params._dummy(), "sizes", "number of slots per feature (JSON)", TypeConverters.toString)
    levels: DataFrame

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, sizes=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        sizes = json.loads(self.getOrDefault("sizes"))
        cols = self.getInputCols()
        coded = join_levels(df, self.levels, cols, prefix="__fit_")
        indexed = {}
        for c in cols:
            slots = sizes.get(c, 0)
            # Unseen levels take the extra last slot, dropped by the encoder.
            meta = {"ml_attr": {"type": "nominal", "num_vals": slots + 1, "name": f"__{c}_idx"}}
            indexed[f"__{c}_idx"] = F.coalesce(F.col(f"__fit_{c}_slot"), F.lit(slots)).cast("double").alias(f"__{c}_idx", metadata=meta)
        coded = coded.select(*df.columns, *indexed.values())
        enc = OneHotEncoder(inputCols=list(indexed), outputCols=self.getOutputCols(), dropLast=True)
        return enc.fit(coded).transform(coded).drop(*indexed)

    def write(self) -> MLWriter:
        return _LevelsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LevelsReader()


class _LevelsWriter(MLWriter):
    def __init__(self, model: InfrequentOneHotModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.levels.write.mode("overwrite").parquet(f"{path}/levels")


class _LevelsReader(MLReader):
    def load(self, path: str) -> InfrequentOneHotModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = InfrequentOneHotModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.levels = self.sparkSession.read.parquet(f"{path}/levels")
        return model


def feature_assembler(numeric_cols: list[str], vector_cols: list[str], output: str = "features") -> VectorAssembler:
    """Numeric + one-hot columns → one feature vector, remainder dropped (M6)."""
    return VectorAssembler(inputCols=numeric_cols + vector_cols, outputCol=output, handleInvalid="keep")
