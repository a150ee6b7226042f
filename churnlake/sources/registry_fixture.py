"""Registry fixture: versions and a promotion log derived from the prediction log.

Every (model line, week) of the log is taken as a trained version whose offline
metrics are measured against the users' actual next-day activity; the promotion
log is what the statuses imply. Test input for the registry queries, not an
operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.operators.evaluate import auc


def weekly_versions(scored: DataFrame) -> DataFrame:
    """scored: (model_version, prediction_time, churn_probability, predicted_label,
    actual_label). One registry row per (model line, week)."""
    s = (scored.withColumn("model_name", F.concat(F.lit("churn-"), F.col("model_version")))
         .withColumn("training_date", F.date_trunc("WEEK", F.col("prediction_time")).cast("timestamp_ntz")))
    p, a = F.col("predicted_label"), F.col("actual_label")
    counts = s.groupBy("model_name", "training_date").agg(
        F.count(F.lit(1)).alias("training_samples"),
        F.count_if((p == 1) & (a == 1)).alias("tp"), F.count_if((p == 1) & (a == 0)).alias("fp"),
        F.count_if((p == 0) & (a == 1)).alias("fn"),
        F.avg("churn_probability").alias("avg_probability"))
    aucs = auc(s, score="churn_probability", label="actual_label", by=["model_name", "training_date"])
    j = counts.join(aucs.select("model_name", "training_date", "auc"), ["model_name", "training_date"], "left")
    prec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    f1 = F.try_divide(F.lit(2.0) * prec * rec, prec + rec)
    metrics = F.struct(F.col("auc").alias("auc"), prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))
    return j.select("model_name",
                    F.concat(F.col("model_name"), F.lit("."), F.date_format("training_date", "yyyyMMdd")).alias("version"),
                    "training_date", "training_samples", "avg_probability",
                    F.to_json(metrics).alias("metrics_json"))


def promotions(status: DataFrame) -> DataFrame:
    """The promotion log implied by the statuses, with timestamps."""
    d = F.col("training_date")
    day = lambda n: d + F.make_dt_interval(F.lit(n))
    st = F.col("status")
    steps = F.array(
        F.struct(F.lit("candidate").alias("from_status"), F.lit("staging").alias("to_status"), day(1).alias("promoted_at"),
                 (F.col("accepted")).alias("happened")),
        F.struct(F.lit("candidate").alias("from_status"), F.lit("failed").alias("to_status"), day(1).alias("promoted_at"),
                 (~F.col("accepted")).alias("happened")),
        F.struct(F.lit("staging").alias("from_status"), F.lit("production").alias("to_status"), day(2).alias("promoted_at"),
                 st.isin("production", "deprecated").alias("happened")),
    )
    base = status.select("model_name", "version", F.inline(steps)).filter("happened").drop("happened")
    # deprecation happens when the next production version is promoted
    prod = base.filter(F.col("to_status") == "production")
    w = Window.partitionBy("model_name").orderBy("promoted_at")
    dep = (prod.withColumn("next_at", F.lead("promoted_at").over(w))
           .filter(F.col("next_at").isNotNull())
           .select("model_name", "version", F.lit("production").alias("from_status"),
                   F.lit("deprecated").alias("to_status"), F.col("next_at").alias("promoted_at")))
    return base.unionByName(dep)


def with_skipped_steps(log: DataFrame) -> DataFrame:
    """The log with a transition that skips staging for every failed version, as
    a faulty writer would have left it."""
    bad = (log.filter(F.col("to_status") == "failed")
           .select("model_name", "version", F.lit("failed").alias("from_status"),
                   F.lit("production").alias("to_status"),
                   (F.col("promoted_at") + F.make_dt_interval(F.lit(3))).alias("promoted_at")))
    return log.unionByName(bad)
