"""Stage tables: plans are built without a job, a second call gets the same frames,
nothing is persisted twice, and the daily rows are scanned once."""

import pytest

from ledgerlake.plans import queries as q
from ledgerlake.plans.prices import monthly_prices
from ledgerlake.plans.stages import Stages
from ledgerlake.sources import fixtures

SF = "/root/testdata/sf0.001"
PRICE_FRAMES = ["monthly_raw", "monthly_final", "merged", "price_model"]
PRICE_QUERIES = ["daily_to_monthly", "trailing_returns", "market_join", "excess_return_target", "dedupe_cusip_month", "panel_price_join"]


def jobs(spark, group, act):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        act()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def persisted(spark):
    return len(spark.sparkContext._jsc.getPersistentRDDs())


@pytest.fixture
def released(spark):
    q.forget(spark)
    yield
    q.forget(spark)


def test_building_price_plans_runs_no_job(spark, released):
    def build():
        return [q.QUERIES[n](spark, SF)._jdf.queryExecution().optimizedPlan() for n in PRICE_QUERIES]

    # Spark reads the schema of a Parquet table in a job of its own, once for each table read.
    schemas = jobs(spark, "schemas", lambda: (fixtures.panel_d(spark, SF), fixtures.panel_q_raw(spark, SF)))
    assert jobs(spark, "first build", build) == schemas
    assert jobs(spark, "second build", build) == 0
    assert jobs(spark, "run", lambda: q.QUERIES["market_join"](spark, SF).count()) > 0


def test_second_call_hits_and_persisted_frames_stay_constant(spark, released):
    others = persisted(spark)  # by other tests
    frames = [getattr(q, n)(spark, SF) for n in PRICE_FRAMES]
    for n in PRICE_QUERIES:
        q.QUERIES[n](spark, SF).count()
    before, keys = persisted(spark), q.STAGES.keys()
    for n in PRICE_QUERIES:
        q.QUERIES[n](spark, SF).count()
    assert persisted(spark) == before and q.STAGES.keys() == keys
    assert all(getattr(q, n)(spark, SF) is f for n, f in zip(PRICE_FRAMES, frames))
    q.forget(spark)
    assert persisted(spark) == others and q.STAGES.keys() == []


def test_daily_rows_are_scanned_once(spark, released):
    """Every daily row passes an observed point once, however many branches read the monthly rows."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    daily = fixtures.panel_d(spark, SF)
    total = daily.count()
    watched = daily.mapInArrow(counted, daily.schema)
    stages = Stages()
    final = monthly_prices(watched, stage=lambda df: stages.frame(spark, "monthly", lambda: df))
    assert final.count() > 0 and final.count() > 0
    assert seen.value == total
    stages.release(spark)


def test_stages_are_kept_by_key_and_released(spark):
    stages, built = Stages(), []

    def build():
        built.append(1)
        return spark.range(3)

    a = stages.frame(spark, "a", build)
    assert stages.frame(spark, "a", build) is a and len(built) == 1 and a.is_cached
    stages.release(spark, "a")
    assert not a.is_cached and stages.frame(spark, "a", build) is not a and len(built) == 2
    stages.release(spark)
