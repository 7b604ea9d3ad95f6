"""Physical-plan summary of the registered queries that build lazily.

For each query: hash / single-partition exchanges, broadcast exchanges,
aggregate kinds, windows, joins and Python evaluation nodes, read from the
static executed plan (AQE off). The input panels are materialised first, so
the counts cover the library's operators only. They include every re-read of
an upstream stage inside one query (the split's cut-date subquery, the
two-pass exact quantiles); in `pipeline.run` those stages are written
tables. Usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Queries whose construction runs a fit (k-means / PCA / preprocessor) or a
# file listing are skipped: their plans are built after eager fitting.
EAGER = {"discover_source", "duplicate_files", "feature_vectors", "pca_features", "kmeans_clusters",
         "cluster_profile", "pca_explained_variance", "plot_sample", "price_numeric_pipeline",
         "missingness_top20", "impute_median", "clip_quantiles", "standard_scale", "numeric_pipeline"}

OPS = {
    "hash_exch": r"Exchange hashpartitioning",
    "single_exch": r"Exchange SinglePartition",
    "range_exch": r"Exchange rangepartitioning",
    "bcast": r"BroadcastExchange",
    "hash_agg": r"(?<!Object)HashAggregate\(",
    "obj_agg": r"ObjectHashAggregate\(",
    "sort_agg": r"SortAggregate\(",
    "window": r"\bWindow \[",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "python": r"(BatchEvalPython|ArrowEvalPython|PythonUDF|MapInPandas|FlatMapGroupsInPandas)",
}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    from ledgerlake.plans.queries import QUERIES
    from ledgerlake.session import build_session

    from ledgerlake.session import scratch_path
    from ledgerlake.sources import fixtures
    import uuid

    spark = build_session("local[4]", shuffle_partitions=4)
    spark.conf.set("ledgerlake.fixture.cache", scratch_path(spark, f"plan-inputs-{uuid.uuid4().hex[:12]}"))
    fixtures.panel_q_raw(spark, sf).count()
    fixtures.panel_d(spark, sf).count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan: what the optimizer chose
    print("| query | " + " | ".join(OPS) + " |")
    print("|---|" + "---|" * len(OPS))
    for name, q in QUERIES.items():
        if name in EAGER:
            continue
        plan = q(spark, sf)._jdf.queryExecution().executedPlan().toString()
        counts = [str(len(re.findall(p, plan))) for p in OPS.values()]
        print(f"| {name} | " + " | ".join(counts) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
