"""Every registered query that has SQL equals it; a few of the others run."""

import pytest
from compare import compare
from conftest import SF_DIR

import __spark_entry__ as entry_point

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    verdict = compare(QUERIES[name](spark, SF_DIR), duck, ORACLES[name])
    assert verdict in (None, "inexact"), verdict


@pytest.mark.parametrize("name", ["a07_approx_distinct_counts", "a14_approx_quantile_summary", "a15_approx_iqr_summary",
                                  "f05_random_sample", "m05_preprocessed_columns", "m10_pca_share", "m11_pca_points",
                                  "p12_schema_table", "l01_balanced_logistic", "l06_boosted_on_log",
                                  "b08_rfm_segments", "b04_labelled_segments"])
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry_and_registry(spark):
    assert entry_point.entry(spark).columns == ["contract", "churn_rate_pct"]
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ["a24_churn_rate_by_contract", "a28_fill_with_mean", "e04_average_precision",
                                  "e11_cluster_stability", "m01_standard_scale", "a36_box_stats_by_contract",
                                  "j04_frequency_lookup_large", "a35_histogram_50"])
def test_no_pairwise_join(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def _formatted(spark, name):
    execution = QUERIES[name](spark, SF_DIR)._jdf.queryExecution()
    return spark.sparkContext._jvm.PythonSQLUtils.explainString(execution, "formatted")


def test_scan_is_pruned_and_filtered(spark):
    plan = _formatted(spark, "s03_parquet_scan")
    pushed = [line for line in plan.splitlines() if line.startswith("PushedFilters")][0]
    assert "EqualTo(o_orderstatus,P)" in pushed and "GreaterThan(o_totalprice,400000.0)" in pushed
    assert "o_orderpriority" not in plan
    plan = _formatted(spark, "a20_charge_by_contract")
    assert "lineitem.parquet" not in plan and "events.parquet" not in plan
