"""Statistics against published values and guard cases."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlake.functions import stats as ST
from churnlake.operators import abtest as AB
from churnlake.operators import evaluate as EV
from churnlake.operators import monitor as M


@pytest.mark.parametrize("t,dof,p", [(2.228, 10, 0.05), (2.086, 20, 0.05), (1.96, 1e7, 0.05), (2.576, 1e7, 0.01),
                                     (12.706, 1, 0.05), (0.0, 5, 1.0), (3.169, 10, 0.01)])
def test_t_pvalue_matches_tables(t, dof, p):
    assert abs(float(ST.t_two_sided_pvalue_np(t, dof)) - p) < 5e-4


def test_betainc_symmetry():
    a, b, x = 2.5, 0.5, np.linspace(0.01, 0.99, 25)
    assert np.allclose(ST.betainc(a, b, x) + ST.betainc(b, a, 1 - x), 1.0, atol=1e-12)


def test_erf_and_normal_cdf(spark):
    xs = [-3.0, -1.0, -0.3, 0.0, 0.5, 1.7, 4.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(ST.erf(F.col("x"))).collect()]
    for x, g in zip(xs, got):
        assert abs(g - math.erf(x)) < 2e-7
    phi = df.select(ST.normal_cdf(F.col("x"), F.lit(0.0), F.lit(1.0))).collect()
    assert abs(phi[3][0] - 0.5) < 1e-7


def test_kolmogorov_pvalue_known_values(spark):
    # asymptotic Q_KS(lambda): Q(1.36) ~ 0.05, Q(1.63) ~ 0.01 (n large)
    df = spark.createDataFrame([(1.36 / math.sqrt(1e6), 1e6), (1.63 / math.sqrt(1e6), 1e6), (0.0001, 10.0)], "d double, n double")
    p = [r[0] for r in df.select(ST.kolmogorov_pvalue(F.col("d"), F.col("n"))).collect()]
    assert abs(p[0] - 0.0494) < 2e-3 and abs(p[1] - 0.0098) < 1e-3 and p[2] == 1.0


def test_running_totals_exact(spark):
    rows = [(g, float(v), 1) for g in ("a", "b") for v in range(200)]
    df = spark.createDataFrame(rows, "g string, v double, c int")
    out = ST.running_totals(df, ["g"], "v", ["c"], buckets=7).collect()
    for r in out:
        assert r["cum_c"] == int(r["v"]) + 1


def test_auc_ties_and_one_class(spark):
    eq = spark.createDataFrame([(0.3, 1), (0.3, 0), (0.3, 1), (0.3, 0)], "churn_probability double, churned_30d int")
    assert EV.auc(eq).collect()[0]["auc"] == 0.5
    one = spark.createDataFrame([(0.3, 1), (0.7, 1)], "churn_probability double, churned_30d int")
    assert EV.auc(one).collect()[0]["auc"] is None
    perfect = spark.createDataFrame([(0.1, 0), (0.2, 0), (0.8, 1), (0.9, 1)], "churn_probability double, churned_30d int")
    assert EV.auc(perfect).collect()[0]["auc"] == 1.0


def test_mean_change_with_zero_baseline(spark):
    df = spark.createDataFrame([(2.0, 0.0)], "cur double, base double")
    v = df.select(M.drift_mean_change(F.col("cur"), F.col("base"))).collect()[0][0]
    assert math.isfinite(v) and abs(v - 2.0 / 1e-6 * 100) < 1e-3


def _results(spark, rows):
    return spark.createDataFrame(rows, "test_name string, variant string, churn_probability double, latency_ms double")


def test_ab_guards(spark):
    one_variant = _results(spark, [("t1", "control", 0.5, 1.0), ("t1", "control", 0.6, 1.0)])
    r = AB.all_tests(one_variant).collect()[0]
    assert r["status"] == "insufficient_data" and r["winner"] == "none" and r["p_value"] == 1.0
    single_row = _results(spark, [("t2", "control", 0.5, 1.0), ("t2", "control", 0.6, 1.0), ("t2", "variant", 0.1, 1.0)])
    r = AB.all_tests(single_row).collect()[0]
    assert r["p_value"] == 1.0 and r["t_statistic"] == 0.0 and r["winner"] == "control"
    zero_var = _results(spark, [("t3", "control", 0.5, 1.0), ("t3", "control", 0.5, 1.0),
                                ("t3", "variant", 0.2, 1.0), ("t3", "variant", 0.3, 1.0)])
    assert AB.all_tests(zero_var).collect()[0]["p_value"] == 1.0


def test_ab_reference_fixture(spark):
    """100 users: control 0.50 + (i % 20)/100, variant 0.45 + (i % 20)/100."""
    rows = [("test_v2_rollout", "control", 0.50 + (i % 20) / 100, 0.5 + (i % 5) * 0.05) for i in range(50)]
    rows += [("test_v2_rollout", "variant", 0.45 + (i % 20) / 100, 0.4 + (i % 5) * 0.05) for i in range(50)]
    r = AB.all_tests(_results(spark, rows)).collect()[0]
    m1 = np.array([0.50 + (i % 20) / 100 for i in range(50)])
    m2 = m1 - 0.05
    s = math.sqrt(m1.var(ddof=1) / 50 + m2.var(ddof=1) / 50)
    assert abs(r["t_statistic"] - 0.05 / s) < 1e-9
    assert abs(r["dof"] - 98.0) < 1e-6
    assert r["winner"] == "variant" and r["p_value"] < 0.05


def test_hash_assignment_is_sticky_and_split(spark):
    users = spark.range(20000).select(F.col("id").alias("user_id"), F.lit("exp").alias("test_name"),
                                      F.lit(None).cast("timestamp_ntz").alias("first_seen"))
    tests = spark.createDataFrame([("exp", "1.0", "2.0", 0.3, "active")],
                                  "test_name string, control_version string, variant_version string, "
                                  "traffic_split double, status string")
    a1 = AB.assign_new(users, tests)
    share = a1.agg(F.avg((F.col("variant") == "variant").cast("double"))).collect()[0][0]
    assert abs(share - 0.3) < 0.02
    existing = a1.limit(10).withColumn("variant", F.lit("control"))
    both = AB.sticky_assign(users, existing, tests)
    assert both.count() == 20000
    kept = both.join(existing.select("user_id"), "user_id").filter(F.col("source") == "existing").count()
    assert kept == 10


def test_ansi_safe_on_degenerate_inputs(spark):
    """Spark 4 runs in ANSI mode: zero denominators must give nulls, not errors."""
    from churnlake.operators import validate as V
    empty = spark.createDataFrame([], "a double")
    assert V.validate_nulls(empty).collect()[0]["null_ratio"] is None
    base = spark.createDataFrame([("x", 1.0, 0.0)], "feature_name string, mean double, std double")
    cur = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    r = M.drift_ks(cur, base, ("x",)).collect()[0]
    assert r["ks_statistic"] is None
    only_cur = M.ks_two_sample(cur, spark.createDataFrame([(None,)], "x double"), ("x",)).collect()
    assert only_cur[0]["n2"] == 0
    none = spark.createDataFrame([], "churn_probability double, churned_30d int")
    assert EV.confusion(none).collect()[0]["accuracy"] is None
