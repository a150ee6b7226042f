"""The candidate gate and the promotion audit."""
import datetime as dt

from churnlake.operators import registry as R

VERSIONS = ("model_name string, version string, training_date timestamp_ntz, training_samples long, "
            "avg_probability double, metrics_json string")


def versions(spark, aucs, line="m"):
    day = dt.datetime(2024, 1, 1)
    rows = [(line, f"{line}.{i}", day + dt.timedelta(weeks=i), 10, p,
             f'{{"auc": {a}, "precision": 0.5, "recall": {0.1 * i}}}' if a is not None else None)
            for i, (a, p) in enumerate(aucs)]
    return spark.createDataFrame(rows, VERSIONS)


def test_gate_compares_with_production_not_with_the_week_before(spark):
    v = versions(spark, [(0.60, 0.5), (0.45, 0.5), (0.55, 0.5), (0.62, 0.5), (0.625, 0.5)])
    got = R.candidate_gate(v).orderBy("training_date").collect()
    assert [r["accepted"] for r in got] == [True, False, False, True, False]
    assert [r["prod_version"] for r in got] == [None, "m.0", "m.0", "m.0", "m.3"]
    assert [r["reason"] for r in got] == ["first model", "no gain", "no gain", "auc gain", "no gain"]
    assert abs(got[3]["recall_improvement"] - 0.3) < 1e-12 and got[3]["precision_improvement"] == 0


def test_gate_keeps_a_slightly_worse_model_after_drift(spark):
    got = R.candidate_gate(versions(spark, [(0.6, 0.2), (0.597, 0.9), (0.58, 0.9)])).orderBy("training_date").collect()
    assert [r["reason"] for r in got] == ["first model", "drift", "no gain"]


def test_gate_lines_are_independent_and_missing_metrics_count_as_zero(spark):
    v = versions(spark, [(0.9, 0.5)], "a").unionByName(versions(spark, [(None, 0.5), (0.2, 0.5)], "b"))
    got = {r["version"]: r for r in R.candidate_gate(v).collect()}
    assert got["b.0"]["accepted"] and got["b.1"]["reason"] == "auc gain" and got["b.1"]["prod_auc"] is None


def test_audit_reports_illegal_transitions(spark):
    day = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame(
        [("m", "1", "candidate", "staging", day), ("m", "1", "failed", "production", day + dt.timedelta(1)),
         ("m", "2", "staging", "production", day + dt.timedelta(2)), ("m", "3", None, "staging", day)],
        "model_name string, version string, from_status string, to_status string, promoted_at timestamp_ntz")
    got = {(r["version"], r["to_status"]): r for r in R.promotion_audit(log).collect()}
    assert [got[k]["is_legal"] for k in sorted(got)] == [False, True, True, False]
    assert got[("2", "production")]["displaced_version"] == "1"
