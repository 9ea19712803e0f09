"""Plan properties of every registered query (no execution needed except
for the small materializations some queries do while being built)."""
import re

import pytest

from feedlens.plans import catalog
from feedlens.operators import metrics
from feedlens.sources import fixtures

from .conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.registry()))
def test_no_cross_join_and_no_python_in_plan(spark, name):
    plan = _plan(catalog.registry()[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_user_day_distinct_is_combined_map_side(spark):
    # a hot user must be collapsed before the shuffle on (dt, user_id)
    plan = metrics.feed_daily(fixtures.feed_actions(spark, SF_SMALL))._jdf \
        .queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    idx = next(i for i, ln in enumerate(lines)
               if "Exchange hashpartitioning(dt" in ln and "user_id" in ln)
    below = "\n".join(lines[idx + 1: idx + 3])
    assert re.search(r"HashAggregate\(keys=\[dt#\d+, user_id#\d+L?\], functions=\[partial_", below)


def test_day_window_reaches_the_scan(spark):
    from feedlens.plans import reports
    prev = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        df = reports.feed_traffic(fixtures.feed_actions(spark, SF_SMALL), "2024-01-31")
        plan = _plan(df)
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", prev)
    pushed = re.findall(r"PushedFilters: (\[.*?\])(?:, ReadSchema|$)", plan, re.M)
    assert any("GreaterThanOrEqual(ts,2024-01-24" in p for p in pushed), pushed


def _scans(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def _jobs_while_building(spark, name) -> int:
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build-{name}", name)
    try:
        catalog.registry()[name](spark, SF_SMALL)
        return len(tracker.getJobIdsForGroup(f"build-{name}"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", ["ab_test_03", "ab_test_12", "welch_ctr", "welch_linearized", "control_ctr",
                                  "ctr_histogram", "linearized_histogram", "linearized_likes"])
def test_experiments_run_no_job_while_the_plan_is_built(spark, name):
    assert _jobs_while_building(spark, name) == 0


def test_a_test_reads_its_events_once(spark):
    for name in ("ab_test_03", "welch_linearized"):
        df = catalog.registry()[name](spark, SF_SMALL)
        plan = _plan(df)
        assert plan.count("Location: ") == 3 and "Subquery" not in plan, name    # events, customer, nation


def test_a_histogram_reads_its_source_once(spark):
    """Bounds and bins come from one count per value: both read one shuffle."""
    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderpriority", "o_totalprice")
    from feedlens.operators.experiments import histogram

    df = histogram(src, "o_totalprice", 20, "o_orderpriority")
    rows = df.collect()
    assert sum(r.n for r in rows) == src.count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") + final.count("ReusedQueryStage") >= 1 or final.count("FileScan") == 1


@pytest.mark.parametrize("name", ["linearized_likes", "linearized_histogram", "ctr_histogram", "control_ctr"])
def test_linearized_metrics_scan_the_events_once(spark, name):
    """Also with a control CTR and a range: the other readers reuse the shuffle."""
    df = catalog.registry()[name](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    nodes = [line for line in plan.splitlines() if "FileScan parquet" in line and "event_type" in line]
    # the subquery of a single histogram runs first, and the main plan reuses its shuffle
    assert len(nodes) == (0 if name == "ctr_histogram" else 1) and ("Reused" in plan or name == "control_ctr"), name


def test_no_filter_holds_the_p_value_integral(spark):
    for name in ("aa_pvalue_histogram", "aa_false_positive_rate"):
        plan = _plan(catalog.registry()[name](spark, SF_SMALL))
        assert not any("aggregate(" in line for line in plan.splitlines() if re.search(r"\bFilter\b", line)), name


def test_a_filter_on_p_stays_cheap(spark):
    from feedlens.functions.stats import with_p_value

    df = with_p_value(spark.range(1, 2000).selectExpr("id / 500.0D AS t", "id + 0.5D AS df")).filter("p < 0.5 AND p IS NOT NULL")
    assert max(map(len, df._jdf.queryExecution().optimizedPlan().toString().splitlines())) < 40_000
    assert 0 < df.count() < 2000
