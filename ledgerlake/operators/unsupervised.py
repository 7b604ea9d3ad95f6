"""PCA and k-means cluster features fitted on the training split.

The covariance of the scaled features is one aggregate (d (d + 1) / 2
co-moments); its eigenvectors are a d x d problem on the driver. k-means is
`operators/kmeans.py`. The fitted values (d loadings per component, k
centres) are applied as column expressions: no Python runs per row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.constants import (
    N_CLUSTER_RESTARTS,
    N_CLUSTERS,
    N_PCA_COMPONENTS,
    RANDOM_STATE,
)
from ledgerlake.operators.kmeans import fit_kmeans
from ledgerlake.operators.prep import NumericPrep, NumericPrepModel
from ledgerlake.operators.quantiles import grouped_median

ROWS_A_PART = 1 << 16
SHIFT_TOLERANCE = 1e-4  # of the mean variance: the sum of squared centre shifts at which a fit stops


@dataclass
class ClusterArtifacts:
    features: list[str]
    prep: NumericPrepModel
    pca_mean: list[float]
    pca_components: list[list[float]]
    explained_variance: list[float]
    explained_variance_ratio: list[float]
    centers: list[list[float]]
    training_cost: float
    restarts: list[float] = field(default_factory=list)
    iterations: list[int] = field(default_factory=list)


def _scaled_names(cols: list[str]) -> list[str]:
    return [f"__s_{c}" for c in cols]


def fix_signs(components: list[list[float]]) -> tuple[list[list[float]], list[float]]:
    """Components whose largest-magnitude loading is positive, and the sign
    (1 or -1) that each was multiplied by."""
    signs = [-1.0 if max(comp, key=abs) < 0 else 1.0 for comp in components]
    return [[s * v for v in comp] for s, comp in zip(signs, components)], signs


def covariance(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature_a, feature_b, mean_a, mean_b, covariance) for a <= b: one aggregate over the
    rows whose buffer, co-moments that merge map-side, does not grow with them."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                  *[F.covar_samp(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    at = {c: i for i, c in enumerate(cols)}
    rows = F.array(*[F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"m{at[a]}").alias("mean_a"),
                              F.col(f"m{at[b]}").alias("mean_b"), F.col(f"c{i}").alias("covariance")) for i, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(rows))


def _moments(df: DataFrame, cols: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Means and covariance matrix (d (d + 1) / 2 numbers on the driver)."""
    at = {c: i for i, c in enumerate(cols)}
    mean, matrix = np.zeros(len(cols)), np.zeros((len(cols), len(cols)))
    for r in covariance(df, cols).collect():
        i, j = at[r.feature_a], at[r.feature_b]
        mean[i], mean[j] = r.mean_a, r.mean_b
        matrix[i, j] = matrix[j, i] = r.covariance or 0.0  # one row has none
    return mean, matrix


def principal_components(matrix: np.ndarray, n_components: int) -> tuple[list[list[float]], list[float], list[float]]:
    """Sign-fixed unit eigenvectors of a covariance matrix by falling eigenvalue, the eigenvalues, and their shares of the trace."""
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1][:n_components]
    components, _ = fix_signs(vectors[:, order].T.tolist())
    trace = float(np.trace(matrix))
    return components, values[order].tolist(), [float(v) / trace if trace > 0 else 0.0 for v in values[order]]


def fit_cluster_features(train: DataFrame, cols: list[str], k: int = N_CLUSTERS,
                         restarts: int = N_CLUSTER_RESTARTS, seed: int = RANDOM_STATE,
                         n_components: int = N_PCA_COMPONENTS, exact: bool = True) -> ClusterArtifacts:
    """Fit the numeric pipeline, PCA and k-means on the training rows only.

    k-means keeps the cheapest of `restarts` seeded fits, which share each scan of the
    rows; centres are put in lexicographic order so that labels are stable. The
    fit depends on the rows, not on how they are laid out."""
    scaled = _scaled_names(cols)
    train = train.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)  # read by every fit below
    prep = NumericPrep(inputCols=cols, outputCols=scaled, exact=exact).fit(train)
    # k-means scans these rows many times: no more parts than they need.
    parts = max(train.sparkSession.sparkContext.defaultParallelism, train.count() // ROWS_A_PART + 1)
    rows = prep.transform(train).select(*scaled).coalesce(parts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        mean, matrix = _moments(rows, scaled)
        components, variances, ratios = principal_components(matrix, n_components)
        fit = fit_kmeans(rows, k, restarts, seed, SHIFT_TOLERANCE * float(np.trace(matrix)) / len(cols))
    finally:
        rows.unpersist()
        train.unpersist()
    return ClusterArtifacts(cols, prep, mean.tolist(), components, variances, ratios, sorted(fit.centers.tolist()),
                            fit.cost, fit.costs, fit.iterations)


_VEC = "__cluster_vec"
CLUSTER_OUTPUT_COLUMNS = ["cluster_pca1", "cluster_pca2", "finance_cluster"]


def _nearest(vector: Column, centers: list[list[float]]) -> Column:
    """Number of the nearest centre, the first among equals."""
    points = F.array(*[F.array(*[F.lit(v) for v in center]) for center in centers])
    squares = F.transform(points, lambda c: F.aggregate(
        F.zip_with(vector, c, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x))
    return F.get(F.transform(F.array(squares), lambda d: F.array_position(d, F.array_min(d))), F.lit(0)) - 1


def add_cluster_features(df: DataFrame, art: ClusterArtifacts, only_where: Column | None = None) -> DataFrame:
    """Add cluster_pca1..n and finance_cluster (M7, M8) from the fitted values,
    as expressions over one array of the scaled features. PCA outputs are centred
    on the training mean. With `only_where`, rows not matching it get missing values."""
    scaled = art.prep.expressions()
    staged = df.withColumn(_VEC, F.array(*[scaled[c] for c in _scaled_names(art.features)]))
    vector = F.col(_VEC)
    outs = {}
    for j, comp in enumerate(art.pca_components):
        loadings = F.array(*[F.lit(v) for v in comp])
        offset = sum(m * w for m, w in zip(art.pca_mean, comp))
        outs[f"cluster_pca{j + 1}"] = F.aggregate(F.zip_with(vector, loadings, lambda x, w: x * w), F.lit(-offset), lambda t, x: t + x)
    outs["finance_cluster"] = F.concat(F.lit("cluster_"), _nearest(vector, art.centers).cast("string"))
    if only_where is not None:
        outs = {k: F.when(only_where, v) for k, v in outs.items()}
    return staged.withColumns(outs).drop(_VEC)


def cluster_profile(train_labelled: DataFrame, cols: list[str]) -> DataFrame:
    """Per cluster over the training rows: median of each feature (rounded
    half-even to 4 decimals) and the row count (A9)."""
    med = grouped_median(train_labelled.select("finance_cluster", *cols), ["finance_cluster"], cols)
    counts = train_labelled.groupBy("finance_cluster").agg(F.count(F.lit(1)).alias("row_count"))
    return (counts.join(med, "finance_cluster", "left")
            .select("finance_cluster", *[F.bround(F.col(c), 4).alias(c) for c in cols], "row_count"))


def explained_variance(train_labelled: DataFrame, art: ClusterArtifacts) -> DataFrame:
    """(component, explained_variance_ratio) measured on the training rows (A14): the variance of
    each projected component over the summed variance of the scaled features."""
    scaled = art.prep.expressions()
    parts = [f"cluster_pca{j + 1}" for j in range(len(art.pca_components))]
    rows = train_labelled.select(*parts, *[scaled[c].alias(c) for c in _scaled_names(art.features)])
    total = sum((F.var_samp(c) for c in _scaled_names(art.features)), F.lit(0.0))
    wide = rows.agg(*[F.try_divide(F.var_samp(p), total).alias(p) for p in parts])
    return (wide.unpivot([], parts, "name", "explained_variance_ratio")
            .select(F.replace("name", F.lit("cluster_pca"), F.lit("")).cast("int").alias("component"), "explained_variance_ratio"))


def component_residuals(train: DataFrame, art: ClusterArtifacts) -> DataFrame:
    """(component, eigenvalue, residual): for each loading vector v, the Rayleigh quotient v'Cv and the largest
    |Cv - v'Cv v|, with the covariance C computed from the training rows."""
    scaled = art.prep.expressions()
    names = _scaled_names(art.features)
    c = covariance(train.select(*[scaled[n].alias(n) for n in names]), names)
    # Both halves of the symmetric matrix.
    full = c.select("feature_a", "feature_b", "covariance").union(
        c.filter("feature_a <> feature_b").select(F.col("feature_b"), F.col("feature_a"), "covariance"))
    spark = train.sparkSession
    v = spark.createDataFrame([(j + 1, n, w) for j, comp in enumerate(art.pca_components) for n, w in zip(names, comp)],
                              "component int, feature string, loading double")
    product = (full.join(v, F.col("feature_b") == F.col("feature")).groupBy("component", "feature_a")
               .agg(F.sum(F.col("covariance") * F.col("loading")).alias("cv")))
    both = product.join(v.withColumnRenamed("feature", "feature_a"), ["component", "feature_a"])
    value = both.groupBy("component").agg(F.sum(F.col("cv") * F.col("loading")).alias("eigenvalue"))
    return (both.join(value, "component").groupBy("component")
            .agg(F.max("eigenvalue").alias("eigenvalue"),
                 F.max(F.abs(F.col("cv") - F.col("eigenvalue") * F.col("loading"))).alias("residual")))
