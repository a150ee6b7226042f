"""Prediction log and A/B result fixtures derived from the ``events`` table.

One prediction per event: id = event_id, time = ts, probability =
least(value / 500, 1), label = probability >= 0.1, latency = (event_id % 50) / 10,
served from cache unless the event is an error, model version by id parity.
The logged feature JSON is the user's daily snapshot (mapping A) as of the
midnight of the prediction day, so drift jobs see real feature values.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.operators import features as FE
from churnlake.sources import schemas as S
from churnlake.sources.tables import Domain, mapping_a, read_table

AS_OF = "2024-01-31"
LOG_GRID_START = "2024-01-01"
LOG_GRID_DAYS = 31


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    prob = "least(value / 500.0D, 1.0D)"
    return ev.selectExpr(
        "CAST(event_id AS BIGINT) AS prediction_id",
        "CAST(user_id AS BIGINT) AS user_id",
        f"{prob} AS churn_probability",
        f"CAST(CASE WHEN {prob} >= 0.1D THEN 1 ELSE 0 END AS INT) AS predicted_label",
        "ts AS prediction_time",
        "CAST(NULL AS STRING) AS features",
        "CASE WHEN event_id % 2 = 0 THEN '1.0' ELSE '2.0' END AS model_version",
        "(event_id % 50) / 10.0D AS latency_ms",
        "event_type != 'error' AS from_cache",
        "false AS is_monitored",
    )


def of_logged_users(d: Domain, log: DataFrame) -> Domain:
    """``d`` without the users that the log, to which their days are joined, never names."""
    return replace(d, users=d.users.join(log.select("user_id").distinct(), "user_id", "left_semi"))


def daily_vectors(d: Domain) -> DataFrame:
    """Every user's monitored features at every midnight of January 2024."""
    return FE.feature_grid(d, FE.make_grid(LOG_GRID_START, LOG_GRID_DAYS, 1), S.MONITORED_FEATURES)


def prediction_log_with_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with ``features`` = JSON of the seven monitored features. Numbers
    are joined; the text is made of them afterwards."""
    log = prediction_log(spark, sf_dir).drop("features")
    vec = daily_vectors(of_logged_users(mapping_a(spark, sf_dir), log)).withColumn("has_vector", F.lit(True))
    keyed = log.withColumn("feature_date", F.date_trunc("DAY", F.col("prediction_time")).cast("timestamp_ntz"))
    features = F.to_json(F.struct(*[F.col(c) for c in S.MONITORED_FEATURES]))
    return (keyed.join(vec, ["user_id", "feature_date"], "left")
            .withColumn("features", F.when(F.col("has_vector"), features))
            .select(*[f.name for f in S.PREDICTIONS.fields]))


def training_baseline_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows the model was trained on: weekly snapshots, first half of January."""
    return FE.feature_grid(mapping_a(spark, sf_dir), FE.make_grid("2024-01-03", 3, 7))


# --- A/B fixtures ---------------------------------------------------------------

EXISTING_BEFORE = "2024-01-03"


def _test_name(user_id: F.Column) -> F.Column:
    return F.concat(F.lit("exp-"), (user_id % 3).cast("string"))


def ab_user_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One aggregate of the log per user: first / last prediction time and the
    sufficient statistics of the A/B analysis. Every A/B input below derives
    from it (the experiment is a function of the user), so the log is scanned
    and shuffled once; the partial aggregation runs map-side."""
    from churnlake.operators.abtest import user_partials
    log = prediction_log(spark, sf_dir)
    return (user_partials(log, extra=[F.expr("min(prediction_time) AS first_seen"),
                                      F.expr("max(prediction_time) AS last_seen")])
            .withColumn("test_name", _test_name(F.col("user_id"))))


def ab_tests(spark: SparkSession, sf_dir: str, summary: DataFrame | None = None) -> DataFrame:
    """One row per experiment seen in the log: split 0.3 for exp-1 else 0.5;
    exp-2 is completed (inactive), the others active."""
    summary = summary if summary is not None else ab_user_summary(spark, sf_dir)
    t = summary.groupBy("test_name").agg(F.min("first_seen").alias("start_date"),
                                         F.max("last_seen").alias("end_date"))
    return t.select("test_name", F.lit("1.0").alias("control_version"), F.lit("2.0").alias("variant_version"),
                    F.when(F.col("test_name") == "exp-1", 0.3).otherwise(0.5).alias("traffic_split"),
                    "start_date", "end_date",
                    (F.datediff(F.to_date("end_date"), F.to_date("start_date")) + 1).alias("duration_days"),
                    F.when(F.col("test_name") == "exp-2", "completed").otherwise("active").alias("status"))


def ab_candidates(spark: SparkSession, sf_dir: str, summary: DataFrame | None = None) -> DataFrame:
    """(user_id, test_name, first_seen): every user of the log, in its experiment."""
    summary = summary if summary is not None else ab_user_summary(spark, sf_dir)
    return summary.select("user_id", "test_name", "first_seen")


def ab_existing(spark: SparkSession, sf_dir: str, summary: DataFrame | None = None) -> DataFrame:
    """Assignments already stored: users first seen before 2024-01-03, assigned
    by an earlier rule (variant iff bucket >= 5000)."""
    from churnlake.operators.abtest import hash_bucket
    c = ab_candidates(spark, sf_dir, summary).filter(F.col("first_seen") < F.lit(EXISTING_BEFORE).cast("timestamp_ntz"))
    return c.select("user_id", "test_name",
                    F.when(hash_bucket(F.col("test_name"), F.col("user_id")) >= 5000, "variant")
                    .otherwise("control").alias("variant"),
                    F.lit("1.0").alias("control_version"), F.lit("2.0").alias("variant_version"),
                    F.col("first_seen").alias("assigned_at"))


def ab_assignments(spark: SparkSession, sf_dir: str, summary: DataFrame | None = None) -> DataFrame:
    from churnlake.operators.abtest import sticky_assign
    summary = summary if summary is not None else ab_user_summary(spark, sf_dir)
    return sticky_assign(ab_candidates(spark, sf_dir, summary), ab_existing(spark, sf_dir, summary),
                         ab_tests(spark, sf_dir, summary))
