"""Physical-plan properties of the headline jobs: no nested-loop or cartesian
joins, time bounds pushed into the parquet scans, fact tables aggregated before
they are joined."""
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()       # final AQE plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["feature_snapshot_b", "training_dataset", "training_dataset_daily",
                                 "hourly_metrics", "score_batch", "ab_all_tests", "drift_ks", "sessionize", "eval_auc", "psi",
                                 "prediction_summary"])
def test_no_nested_loop_or_cartesian(spark, key):
    p = _plan(E.queries()[key](spark, SF))
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_time_bounds_reach_the_scan(spark):
    df = E.queries()["feature_snapshot_b"](spark, SF)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # scans are printed with all their filters
    p = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    # the 30-day activity window and the 90-day billing window are pushed down
    assert "GreaterThanOrEqual(l_shipdate,1998-05-02T00:00)" in p
    assert "LessThan(l_shipdate,1998-06-01T00:00)" in p
    assert "GreaterThanOrEqual(o_orderdate,1998-03-03T00:00)" in p


def test_no_count_distinct_expand(spark):
    p = _plan(E.queries()["training_dataset"](spark, SF))
    assert "Expand" not in p


def test_scans_are_pruned(spark):
    df = E.queries()["feature_snapshot_b"](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in p
