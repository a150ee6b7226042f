"""Scoring, JSON vectors, monitoring rules on the reference's small fixtures."""
import json
import math

from pyspark.sql import functions as F

from churnlake.operators import monitor as M
from churnlake.operators import scoring as SC
from churnlake.sources import predictions as P
from churnlake.sources import schemas as S
from frames import T


def test_vector_json_round_trip_and_malformed(spark):
    # the reference's single vector (avg 0.5, sessions 10, last login 5, ...)
    vec = spark.createDataFrame([(1, T("2024-01-01 00:00:00"), 0.5, 10, 5, 20, 1, 150.0, 0, 1, 1, 100)], S.FEATURES)
    cache = SC.features_to_json(vec, F.col("feature_date"))
    back = SC.features_from_json(cache, SC.json_schema(vec)).collect()[0]
    assert back["cache_key"] == "user:1:features"
    assert [back[c] for c in S.FEATURE_COLUMNS] == [0.5, 10, 5, 20, 1, 150.0, 0, 1, 1, 100]
    bad = spark.createDataFrame([(2, "user:2:features", "{not json", T("2024-01-01 00:00:00"))],
                                "user_id long, cache_key string, features string, synced_at timestamp_ntz")
    row = SC.features_from_json(bad, SC.json_schema(vec)).collect()
    assert len(row) == 1 and all(row[0][c] is None for c in S.FEATURE_COLUMNS)


def test_missing_feature_counts_as_zero_and_contributions(spark):
    scaler = SC.Scaler({c: 0.0 for c in S.FEATURE_COLUMNS}, {c: 1.0 for c in S.FEATURE_COLUMNS})
    m = SC.LogisticModel(scaler)
    vec = spark.createDataFrame([(1, T("2024-01-01 00:00:00"), None, 0, 0, 0, 0, 0.0, 0, 0, 0, 0)], S.FEATURES)
    p = SC.score_batch(vec.select("user_id"), vec, m).collect()[0]["churn_probability"]
    assert abs(p - 1 / (1 + math.exp(1.5))) < 1e-12
    ex = SC.explain_contributions(vec.withColumn("days_since_last_login", F.lit(2)), m).collect()
    top = [r for r in ex if r["rank"] == 1][0]
    assert top["feature_name"] == "days_since_last_login" and abs(top["contribution"] - 2.4) < 1e-12


def test_score_error_row_for_unknown_user(spark):
    scaler = SC.Scaler({c: 0.0 for c in S.FEATURE_COLUMNS}, {c: 1.0 for c in S.FEATURE_COLUMNS})
    vec = spark.createDataFrame([], S.FEATURES)
    req = spark.createDataFrame([(5,)], "user_id long")
    r = SC.score_batch(req, vec, SC.LogisticModel(scaler)).collect()[0]
    assert r["status"] == "no_features" and r["churn_probability"] is None


def _log(spark):
    rows = []
    for i in range(100):  # reference monitoring fixture
        feats = ('{"avg_sessions_7d": %d, "sessions_30d": %d, "days_since_last_login": %d}'
                 % (5 + i % 10, 20 + i % 30, 5 + i % 20))
        p = 0.5 + (i % 50) / 100
        rows.append((i, i + 1, p, int(p > 0.6), T("2024-01-30 10:00:00"), feats, "1.0", 0.5 + (i % 5) * 0.1, True, False))
    return spark.createDataFrame(rows, S.PREDICTIONS)


def test_hourly_metrics_fixture(spark):
    r = M.hourly_metrics(_log(spark)).collect()
    assert len(r) == 1 and r[0]["total_predictions"] == 100 and r[0]["cache_hit_rate"] == 1.0
    assert r[0]["positive_predictions"] == sum(1 for i in range(100) if 0.5 + (i % 50) / 100 > 0.6)


def test_drift_flags_on_reference_baseline(spark):
    base = spark.createDataFrame([("avg_sessions_7d", 5.0, 2.0), ("sessions_30d", 20.0, 8.0),
                                  ("days_since_last_login", 10.0, 5.0)], "feature_name string, mean double, std double")
    cur = M.prediction_features(_log(spark))
    rep = {r["feature_name"]: r for r in M.drift_report(cur, base, ("avg_sessions_7d", "sessions_30d",
                                                                     "days_since_last_login")).collect()}
    a = rep["avg_sessions_7d"]
    assert abs(a["current_mean"] - 9.5) < 1e-12
    assert abs(a["mean_change_pct"] - 90.0) < 1e-3 and a["drift_detected"]
    assert 0 <= a["ks_statistic"] <= 1


def test_degradation_insufficient_and_degraded(spark):
    rows = [(T("2024-01-01 00:00:00").date(), 0.5, 1.0), (T("2024-01-02 00:00:00").date(), 0.5, 1.0),
            (T("2024-01-28 00:00:00").date(), 0.4, 2.0)]
    m = spark.createDataFrame(rows, "metric_date date, avg_probability double, avg_latency_ms double")
    r = M.performance_degradation(m, "2024-01-31").collect()[0]
    assert r["status"] == "degraded" and abs(r["probability_change_pct"] - 20.0) < 1e-9
    r2 = M.performance_degradation(m.filter("metric_date > date'2024-01-10'"), "2024-01-31").collect()[0]
    assert r2["status"] == "insufficient_data" and not r2["degradation_detected"]


def test_sync_latest_uses_the_date_and_rejects_empty(spark):
    import pytest as _pt
    rows = [(u, T(f"2024-01-{d:02d} 00:00:00"), float(d), d, 1, 1, 0, 1.0, 0, 0, 1, 10) for u in (1, 2) for d in (8, 15)]
    store = spark.createDataFrame(rows, S.FEATURES)
    first = SC.sync_latest(store, "2024-01-08")
    assert {r["avg_sessions_7d"] for r in first.collect()} == {8.0}
    both = SC.sync_latest(store, "2024-01-15", current=first)
    assert {r["avg_sessions_7d"] for r in both.collect()} == {15.0}
    with _pt.raises(ValueError):
        SC.sync_latest(store, "2024-01-22")


def test_recent_predictions_are_not_capped(spark):
    from churnlake.operators import monitor as M
    day = F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")
    log = spark.range(6000).select(F.col("id").alias("prediction_id"), day.alias("prediction_time"),
                                   F.lit("{}").alias("features"))
    assert M.recent_predictions(log, "2024-01-31").count() == 6000
    assert M.recent_predictions(log, "2024-01-31", limit=10).count() == 10


def test_upsert_writes_only_touched_partitions(spark):
    import glob
    import tempfile

    from churnlake.sources.store import upsert_table
    path = tempfile.mkdtemp(prefix="upsert-") + "/t"
    schema = "day int, k string, v double"
    keys = ["day", "k"]
    upsert_table(spark, path, spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (2, "b", 3.0)], schema), keys, "day")
    before = {f for f in glob.glob(path + "/day=*/*.parquet")}
    got = upsert_table(spark, path, spark.createDataFrame([(2, "b", 9.0), (2, "c", None), (3, "a", 5.0)], schema),
                       keys, "day")
    assert sorted(tuple(r) for r in got.select("day", "k").collect()) == [(1, "a"), (2, "a"), (2, "b"), (2, "c"), (3, "a")]
    assert {(r["day"], r["k"]): r["v"] for r in got.collect()}[(2, "b")] == 9.0
    after = {f for f in glob.glob(path + "/day=*/*.parquet")}
    assert {f for f in before if "/day=1/" in f} <= after and not {f for f in before if "/day=2/" in f} & after


def test_variance_of_a_small_spread(spark):
    from churnlake.operators import abtest as AB
    log = spark.range(200_000).select((F.col("id") % 500).alias("user_id"), F.lit(1.0).alias("latency_ms"),
                                      (F.lit(0.5) + F.when(F.col("id") % 2 == 0, 1e-8).otherwise(-1e-8))
                                      .alias("churn_probability"))
    who = spark.range(500).select(F.col("id").alias("user_id"), F.lit("t").alias("test_name"),
                                  F.lit("control").alias("variant"))
    got = AB.results_by_variant_from_partials(AB.user_partials(log), who).first()
    assert abs(got["std_probability"] / 1e-8 - 1) < 1e-5 and got["num_predictions"] == 200_000


def test_a_cluster_without_a_shared_folder_is_an_error():
    import pytest

    from churnlake.session import checkpoint_root

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        checkpoint_root(Session())


def test_logged_features_are_built_for_logged_users_only(spark, tmp_path):
    nation = spark.createDataFrame([(0, "X", 0)], "n_nationkey int, n_name string, n_regionkey int")
    customer = spark.createDataFrame([(k, "c", 0, 0.0, "BUILDING") for k in (1, 1, 2, None)],
                                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    events = spark.createDataFrame([(10, T("2024-01-03 12:00:00"), 1, "view", 5.0, "{}"),
                                    (11, T("2024-01-05 12:00:00"), 1, "view", 5.0, "{}"),
                                    (12, T("2024-01-05 12:00:00"), 7, "view", 5.0, "{}"),
                                    (13, T("2024-01-05 12:00:00"), None, "view", 5.0, "{}"),
                                    (14, T("2024-02-05 12:00:00"), 1, "view", 5.0, "{}")],
                                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    for name, df in (("nation", nation), ("customer", customer), ("events", events)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    log = P.prediction_log_with_features(spark, str(tmp_path))
    got = sorted((r.prediction_id, r.features and json.loads(r.features)["events_30d"]) for r in log.collect())
    # customer 1 is there twice; 7 is none, and February has no vectors
    assert got == [(10, 0), (10, 0), (11, 1), (11, 1), (12, None), (13, None), (14, None)]
    assert log.columns == S.PREDICTIONS.names
    assert "LeftSemi" in log._jdf.queryExecution().optimizedPlan().toString()
