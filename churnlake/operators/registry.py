"""Model registry reads and the retraining decision, set-based
over all models at once.

Registry tables hold one row per version, so what is collected or windowed per
model line here is as long as the line's list of versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.functions.timefn import ts

AUC_GAIN = 0.01
AUC_TOLERANCE_WITH_DRIFT = -0.005
DRIFT_SHIFT_PCT = 10.0

# The legal status transitions of the registry.
LEGAL_TRANSITIONS = (
    ("candidate", "staging"),
    ("candidate", "failed"),
    ("staging", "production"),
    ("staging", "failed"),
    ("production", "deprecated"),
)

METRICS_SCHEMA = T.StructType([T.StructField(c, T.DoubleType()) for c in ("auc", "precision", "recall", "f1")])


def metrics_columns(versions: DataFrame) -> DataFrame:
    """metrics JSON -> typed columns (H4)."""
    m = F.from_json(F.col("metrics_json"), METRICS_SCHEMA)
    return versions.select("model_name", "version", "training_date",
                           *[m[c].alias(c) for c in ("auc", "precision", "recall", "f1")])


def candidate_gate(versions: DataFrame) -> DataFrame:
    """Each candidate against the version in production when it was trained, the
    last accepted one of its line: accept if there is none, or AUC gains > 0.01,
    or AUC loses at most 0.005 while the week drifted (mean probability off the
    line's mean by > 10 %).

    Acceptance depends on earlier acceptances, so a line's versions (one row a
    week) are folded in order of training."""
    v = metrics_columns(versions).join(versions.select("version", "avg_probability"), "version")
    line_mean = F.avg("avg_probability").over(Window.partitionBy("model_name"))
    v = v.withColumn("drift_reason", F.coalesce(
        F.try_divide(F.abs(F.col("avg_probability") - line_mean), F.abs(line_mean)) * 100.0 > DRIFT_SHIFT_PCT,
        F.lit(False)))
    lines = v.groupBy("model_name").agg(F.sort_array(F.collect_list(F.struct(
        "training_date", "version", "auc", "precision", "recall", "drift_reason"))).alias("seen"))
    gain = "coalesce(x.{0}, 0D) - coalesce(s.prod.{0}, 0D)"
    prod = "struct<version:string,auc:double,precision:double,recall:double>"
    row = ("struct<version:string,training_date:timestamp_ntz,auc:double,prod_version:string,prod_auc:double,"
           "auc_improvement:double,precision_improvement:double,recall_improvement:double,drift_reason:boolean,"
           "reason:string,accepted:boolean>")
    reason = (f"CASE WHEN s.prod IS NULL THEN 'first model' WHEN {gain.format('auc')} > {AUC_GAIN}D THEN 'auc gain' "
              f"WHEN {gain.format('auc')} >= {AUC_TOLERANCE_WITH_DRIFT}D AND x.drift_reason THEN 'drift' "
              "ELSE 'no gain' END")
    own = "named_struct('version', x.version, 'auc', x.auc, 'precision', x.precision, 'recall', x.recall)"
    out = ("named_struct('version', x.version, 'training_date', x.training_date, 'auc', x.auc, "
           "'prod_version', s.prod.version, 'prod_auc', s.prod.auc, "
           + "".join(f"'{m}_improvement', {gain.format(m)}, " for m in ("auc", "precision", "recall"))
           + f"'drift_reason', x.drift_reason, 'reason', {reason}, 'accepted', {reason} <> 'no gain')")
    folded = lines.select("model_name", F.explode(F.expr(
        f"aggregate(seen, named_struct('prod', CAST(NULL AS {prod}), 'rows', CAST(array() AS array<{row}>)), "
        f"(s, x) -> named_struct('prod', CAST(CASE WHEN {reason} <> 'no gain' THEN {own} ELSE s.prod END AS {prod}), "
        f"'rows', concat(s.rows, array(CAST({out} AS {row})))), s -> s.rows)")).alias("r"))
    return folded.select("model_name", "r.*")


def version_status(gate: DataFrame, as_of, staging_days: int = 7) -> DataFrame:
    """staging (accepted in the last week), production (latest older accepted),
    deprecated (older accepted), failed (rejected)."""
    recent = F.col("training_date") >= ts(as_of) - F.make_dt_interval(F.lit(staging_days))
    prod_rank = F.row_number().over(Window.partitionBy("model_name", "_old_acc").orderBy(F.col("training_date").desc()))
    g = gate.withColumn("_old_acc", F.col("accepted") & ~recent)
    g = g.withColumn("_rank", prod_rank)
    status = (F.when(~F.col("accepted"), "failed").when(recent, "staging")
              .when(F.col("_rank") == 1, "production").otherwise("deprecated"))
    return g.withColumn("status", status).drop("_old_acc", "_rank")


def promotion_audit(log: DataFrame) -> DataFrame:
    """Each transition of any promotion log (model_name, version, from_status,
    to_status, promoted_at) with its legality and, for promotions to production,
    the version it displaced. A transition to or from null is not legal."""
    spark = log.sparkSession
    legal = spark.createDataFrame([(a, b, True) for a, b in LEGAL_TRANSITIONS],
                                  "from_status string, to_status string, is_legal boolean")
    j = log.join(F.broadcast(legal), ["from_status", "to_status"], "left").fillna(False, ["is_legal"])
    prod = j.filter(F.col("to_status") == "production")
    w = Window.partitionBy("model_name").orderBy("promoted_at")
    displaced = prod.select("model_name", "version", F.lag("version").over(w).alias("displaced_version"))
    return (j.join(displaced, ["model_name", "version"], "left")
            .withColumn("displaced_version", F.when(F.col("to_status") == "production", F.col("displaced_version"))))


def production_model(status: DataFrame, log: DataFrame) -> DataFrame:
    """Latest promoted production version per model line."""
    p = log.filter(F.col("to_status") == "production")
    w = Window.partitionBy("model_name").orderBy(F.col("promoted_at").desc(), F.col("version").desc())
    top = p.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("model_name", "version", "promoted_at")
    cur = status.filter(F.col("status") == "production").select("model_name", "version")
    return top.join(cur, ["model_name", "version"], "inner")


def model_history(status: DataFrame, k: int) -> DataFrame:
    """Newest k versions per model line (a top-k report)."""
    w = Window.partitionBy("model_name").orderBy(F.col("training_date").desc(), F.col("version").desc())
    return (status.withColumn("recency", F.row_number().over(w)).filter(F.col("recency") <= k)
            .select("model_name", "version", "training_date", "status", "auc", "recency"))


def staging_models(status: DataFrame) -> DataFrame:
    return (status.filter(F.col("status") == "staging")
            .select("model_name", "version", "training_date", "auc").orderBy(F.col("training_date").desc()))


def retraining_signals(drift: DataFrame, degradation: DataFrame, volume: DataFrame, min_signals: int = 1) -> DataFrame:
    """One row: drift count + drifted features, degradation, volume, decision."""
    d = drift.agg(F.count_if("drift_detected").alias("drift_count"),
                  F.array_join(F.sort_array(F.collect_list(F.when(F.col("drift_detected"), F.col("feature_name")))),
                               ",").alias("drifted_features"))  # bounded by the number of monitored features
    parts = (d.select(F.lit("drift").alias("signal"), (F.col("drift_count") > 0).alias("detected"),
                      F.col("drift_count").cast("double").alias("value"), "drifted_features")
             .unionByName(degradation.select(F.lit("degradation").alias("signal"),
                                             (F.col("status") == "degraded").alias("detected"),
                                             F.col("probability_change_pct").cast("double").alias("value"),
                                             F.lit(None).cast("string").alias("drifted_features")))
             .unionByName(volume.select(F.lit("volume").alias("signal"), F.col("volume_signal").alias("detected"),
                                        F.col("predictions_7d").cast("double").alias("value"),
                                        F.lit(None).cast("string").alias("drifted_features"))))
    return parts.agg(
        F.count_if("detected").alias("signals"),
        F.max(F.when(F.col("signal") == "drift", F.col("value"))).cast("long").alias("drift_count"),
        F.max("drifted_features").alias("drifted_features"),
        F.max(F.when(F.col("signal") == "degradation", F.col("detected"))).alias("degradation_detected"),
        F.max(F.when(F.col("signal") == "volume", F.col("value"))).cast("long").alias("predictions_7d"),
        F.max(F.when(F.col("signal") == "volume", F.col("detected"))).alias("volume_signal"),
    ).withColumn("should_retrain", F.col("signals") >= min_signals)


def dashboard_summary(status: DataFrame, tests: DataFrame, signals: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row: production versions, staging count, active tests, retraining
    flag, alert count (a union of one-row aggregates folded into columns)."""
    parts = (status.agg(F.count_if(F.col("status") == "production").cast("double").alias("v"))
             .select(F.lit("production_models").alias("k"), "v")
             .unionByName(status.agg(F.count_if(F.col("status") == "staging").cast("double").alias("v"))
                          .select(F.lit("staging_models").alias("k"), "v"))
             .unionByName(tests.agg(F.count_if(F.col("status") == "active").cast("double").alias("v"))
                          .select(F.lit("active_tests").alias("k"), "v"))
             .unionByName(signals.select(F.lit("should_retrain").alias("k"),
                                         F.col("should_retrain").cast("double").alias("v")))
             .unionByName(alerts.agg(F.count(F.lit(1)).cast("double").alias("v"))
                          .select(F.lit("alerts").alias("k"), "v")))
    names = ["production_models", "staging_models", "active_tests", "alerts"]
    return parts.agg(*[F.max(F.when(F.col("k") == n, F.col("v"))).cast("long").alias(n) for n in names],
                     (F.max(F.when(F.col("k") == "should_retrain", F.col("v"))) > 0).alias("should_retrain"))
