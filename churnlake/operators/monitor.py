"""Prediction-log monitoring: metrics, drift, degradation, alerts.

Inputs are the prediction log (``sources.schemas.PREDICTIONS``) and feature
frames. Reference time is always a parameter ``as_of``; nothing reads the clock.
Drift statistics are exact over all recent rows (no sampling); every per-feature
statistic is computed for all features at once on an unpivoted frame whose
aggregates combine map-side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.functions import stats as ST
from churnlake.functions.timefn import ts
from churnlake.sources import schemas as S
from churnlake.sources.store import upsert_table

DRIFT_P = 0.05
DRIFT_MEAN_CHANGE = 30.0
PSI_THRESHOLD = 0.1
ZSCORE_THRESHOLD = 3.0
VOLUME_THRESHOLD = 10000
PROB_DROP_PCT = 10.0
LATENCY_RISE_PCT = 50.0
EPS = 1e-6


def _day(t: Column) -> Column:
    return F.to_date(t)


def _as_of_date(as_of) -> Column:
    return F.to_date(ts(str(as_of)[:10]))


# --- metrics ------------------------------------------------------------------

def hourly_metrics(log: DataFrame, metric_date=None) -> DataFrame:
    """Per (date, hour, version): counts, positives, negatives, mean probability,
    mean latency and cache hit rate. ``metric_date`` limits to one day."""
    if metric_date is not None:
        log = log.filter(_day(F.col("prediction_time")) == F.to_date(ts(str(metric_date)[:10])))
    lab = F.col("predicted_label")
    return (log.groupBy(_day(F.col("prediction_time")).alias("metric_date"),
                        F.hour("prediction_time").alias("metric_hour"), "model_version")
            .agg(F.count(F.lit(1)).alias("total_predictions"),
                 F.count_if(lab == 1).alias("positive_predictions"),
                 F.count_if(lab == 0).alias("negative_predictions"),
                 F.avg("churn_probability").alias("avg_probability"),
                 F.avg("latency_ms").alias("avg_latency_ms"),
                 (F.count_if(F.col("from_cache")) / F.count(F.lit(1))).alias("cache_hit_rate")))


def positive_rate(positive: Column, total: Column) -> Column:
    return F.when(total > 0, F.lit(100.0) * positive / total).otherwise(F.lit(0.0))


def daily_metrics(metrics: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Last ``days`` days of the hourly table: sums and unweighted means of the
    hourly means, newest first, plus the positive rate in percent."""
    since = F.date_sub(_as_of_date(as_of), days)
    d = (metrics.filter(F.col("metric_date") >= since).groupBy("metric_date")
         .agg(F.sum("total_predictions").alias("total_predictions"),
              F.sum("positive_predictions").alias("positive_predictions"),
              F.avg("avg_probability").alias("avg_probability"),
              F.avg("avg_latency_ms").alias("avg_latency_ms"),
              F.avg("cache_hit_rate").alias("cache_hit_rate")))
    return (d.withColumn("positive_rate", positive_rate(F.col("positive_predictions"), F.col("total_predictions")))
            .orderBy(F.col("metric_date").desc()))


def metrics_rollup(metrics: DataFrame) -> DataFrame:
    """Totals by (date, version), by date and overall (ROLLUP)."""
    return (metrics.rollup("metric_date", "model_version")
            .agg(F.sum("total_predictions").alias("total_predictions"),
                 F.sum("positive_predictions").alias("positive_predictions")))


# --- features out of the log -------------------------------------------------

FEATURE_JSON_SCHEMA = T.StructType([T.StructField(c, T.DoubleType()) for c in S.MONITORED_FEATURES])


def prediction_features(log: DataFrame) -> DataFrame:
    """JSON ``features`` -> seven double columns (malformed JSON -> nulls, row kept)."""
    parsed = F.from_json(F.col("features"), FEATURE_JSON_SCHEMA, {"mode": "PERMISSIVE"})
    return log.select("prediction_id", "user_id", "prediction_time", "model_version",
                      *[parsed[c].alias(c) for c in S.MONITORED_FEATURES])


def recent_predictions(log: DataFrame, as_of, days: int = 7, limit: int | None = None) -> DataFrame:
    """Predictions with features in the last ``days`` days: all of them, or with a
    ``limit`` the newest by id."""
    lo = ts(str(as_of)[:10]) - F.make_dt_interval(F.lit(days))
    r = log.filter((F.col("prediction_time") >= lo) & (F.col("prediction_time") < ts(str(as_of)[:10]))
                   & F.col("features").isNotNull())
    if limit is not None:
        r = r.orderBy(F.col("prediction_id").desc()).limit(limit)
    return r


def long_features(frame: DataFrame, features: Sequence[str] = S.MONITORED_FEATURES) -> DataFrame:
    """Unpivot to (feature_name, value) ignoring nulls and NaN."""
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in features)
    lf = frame.selectExpr(f"stack({len(features)}, {stack}) AS (feature_name, value)")
    return lf.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def baseline_statistics(training: DataFrame, features: Sequence[str] = S.MONITORED_FEATURES) -> DataFrame:
    """(feature_name, mean, std, n) of the training rows; the monitor's baseline."""
    return (long_features(training, features).groupBy("feature_name")
            .agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                 F.count(F.lit(1)).alias("n")))


def drift_moments(current: DataFrame, features: Sequence[str] = S.MONITORED_FEATURES) -> DataFrame:
    """(feature_name, n, current_mean, current_std (population), min, max)."""
    return (long_features(current, features).groupBy("feature_name")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("current_mean"),
                 F.stddev_pop("value").alias("current_std"),
                 F.min("value").alias("min_value"), F.max("value").alias("max_value")))


def drift_mean_change(current_mean: Column, baseline_mean: Column) -> Column:
    return F.abs((current_mean - baseline_mean) / (F.abs(baseline_mean) + F.lit(EPS))) * F.lit(100.0)


def drift_ks(current: DataFrame, baseline: DataFrame, features: Sequence[str] = S.MONITORED_FEATURES,
             buckets: int | None = None) -> DataFrame:
    """Exact one-sample KS of the current values against N(baseline mean, std).

    D = max over distinct values x of max(F_n(x) - Phi(x), Phi(x) - F_n(x-)),
    with the empirical CDF from distributed running totals.
    """
    lf = long_features(current, features)
    counts = lf.groupBy("feature_name", "value").agg(F.count(F.lit(1)).alias("c"))
    cum = ST.running_totals(counts, ["feature_name"], "value", ["c"], buckets)
    n = lf.groupBy("feature_name").agg(F.count(F.lit(1)).alias("n"))
    of = n.join(baseline.select("feature_name", F.col("mean").alias("b_mean"), F.col("std").alias("b_std")),
                "feature_name")
    j = ST.attach(cum, of, ["feature_name"], "value")
    phi = ST.normal_cdf(F.col("value"), F.col("b_mean"), F.col("b_std"))
    hi = F.try_divide(F.col("cum_c"), F.col("n"))
    lo = F.try_divide(F.col("cum_c") - F.col("c"), F.col("n"))
    d = (j.withColumn("phi", phi)
         .groupBy("feature_name", "n")
         .agg(F.max(F.greatest(hi - F.col("phi"), F.col("phi") - lo)).alias("ks_statistic")))
    return d.withColumn("p_value", ST.kolmogorov_pvalue(F.col("ks_statistic"), F.col("n").cast("double")))


def ks_two_sample(current: DataFrame, reference: DataFrame, features: Sequence[str] = S.MONITORED_FEATURES,
                  buckets: int | None = None) -> DataFrame:
    """Two-sample KS per feature against actual baseline rows: max |F1 - F2|."""
    a = long_features(current, features).select("feature_name", "value", F.lit(1).alias("c1"), F.lit(0).alias("c2"))
    b = long_features(reference, features).select("feature_name", "value", F.lit(0).alias("c1"), F.lit(1).alias("c2"))
    counts = a.unionByName(b).groupBy("feature_name", "value").agg(F.sum("c1").alias("c1"), F.sum("c2").alias("c2"))
    cum = ST.running_totals(counts, ["feature_name"], "value", ["c1", "c2"], buckets)
    tot = counts.groupBy("feature_name").agg(F.sum("c1").alias("n1"), F.sum("c2").alias("n2"))
    d = (ST.attach(cum, tot, ["feature_name"], "value")
         .groupBy("feature_name", "n1", "n2")
         .agg(F.max(F.abs(F.try_divide(F.col("cum_c1"), F.col("n1")) - F.try_divide(F.col("cum_c2"), F.col("n2"))))
              .alias("ks_statistic")))
    n_eff = F.try_divide(F.col("n1") * F.col("n2"), F.col("n1") + F.col("n2"))
    return d.withColumn("p_value", ST.kolmogorov_pvalue(F.col("ks_statistic"), n_eff.cast("double")))


def drift_report(current: DataFrame, baseline: DataFrame, features: Sequence[str] = S.MONITORED_FEATURES,
                 buckets: int | None = None) -> DataFrame:
    """Per feature: moments, KS vs the baseline normal, mean change, flags.

    drift_detected = p < 0.05 or mean change > 30 %; drift_score = 100 * KS.
    """
    m = drift_moments(current, features)
    ks = drift_ks(current, baseline, features, buckets).drop("n")
    b = baseline.select("feature_name", F.col("mean").alias("baseline_mean"), F.col("std").alias("baseline_std"))
    j = m.join(b, "feature_name").join(ks, "feature_name")
    change = drift_mean_change(F.col("current_mean"), F.col("baseline_mean"))
    return (j.withColumn("mean_change_pct", change)
            .withColumn("drift_detected", (F.col("p_value") < DRIFT_P) | (F.col("mean_change_pct") > DRIFT_MEAN_CHANGE))
            .withColumn("drift_score", F.col("ks_statistic") * F.lit(100.0)))


def drift_rows(report: DataFrame, check_date) -> DataFrame:
    """The ``data_drift`` table rows of one check."""
    return report.select(F.to_date(ts(str(check_date)[:10])).alias("check_date"), "feature_name",
                         F.col("current_mean").alias("mean_value"), F.col("current_std").alias("std_value"),
                         "min_value", "max_value", "drift_detected", "drift_score",
                         F.format_string("Mean change: %.1f%%", F.col("mean_change_pct")).alias("notes"))


def drift_log(spark: SparkSession, path: str, new_rows: DataFrame) -> DataFrame:
    """Full-row upsert into the stored drift log, keyed by (check_date,
    feature_name); returns the table."""
    return upsert_table(spark, path, new_rows, ["check_date", "feature_name"], "check_date")


# --- degradation, alerts, report -----------------------------------------------

def performance_degradation(metrics: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Baseline = metric rows older than 2*days, recent = last ``days`` days; one row.

    status: insufficient_data | ok | degraded (probability drop > 10 % or latency
    rise > 50 %)."""
    today = _as_of_date(as_of)
    md = F.col("metric_date")
    base = md < F.date_sub(today, 2 * days)
    rec = md >= F.date_sub(today, days)
    agg = metrics.agg(
        F.avg(F.when(base, F.col("avg_probability"))).alias("baseline_probability"),
        F.avg(F.when(base, F.col("avg_latency_ms"))).alias("baseline_latency_ms"),
        F.avg(F.when(rec, F.col("avg_probability"))).alias("recent_probability"),
        F.avg(F.when(rec, F.col("avg_latency_ms"))).alias("recent_latency_ms"),
        F.count_distinct(F.when(rec, md)).alias("days_measured"),
        F.count_if(rec).alias("rows_measured"))
    bp, rp = F.col("baseline_probability"), F.col("recent_probability")
    bl, rl = F.col("baseline_latency_ms"), F.col("recent_latency_ms")
    prob_change = F.when((bp.isNotNull()) & (bp != 0), (bp - rp) / bp * 100.0).otherwise(F.lit(0.0))
    lat_change = F.when((bl.isNotNull()) & (bl != 0), (rl - bl) / bl * 100.0).otherwise(F.lit(0.0))
    out = agg.withColumn("probability_change_pct", prob_change).withColumn("latency_change_pct", lat_change)
    degraded = (F.col("probability_change_pct") > PROB_DROP_PCT) | (F.col("latency_change_pct") > LATENCY_RISE_PCT)
    insufficient = bp.isNull() | rp.isNull()
    return (out.withColumn("degradation_detected", F.when(insufficient, F.lit(False)).otherwise(degraded))
            .withColumn("status", F.when(insufficient, "insufficient_data")
                        .when(degraded, "degraded").otherwise("ok")))


def alerts(drift: DataFrame, degradation: DataFrame) -> DataFrame:
    """One warning per drifted feature, one critical alert on degradation."""
    # The two message texts.
    warn = (drift.filter(F.col("drift_detected"))
            .select(F.lit("warning").alias("alert_level"),
                    F.format_string("Data drift detected in %s (%.1f%% change)", F.col("feature_name"),
                                    F.col("mean_change_pct")).alias("message"),
                    F.col("feature_name").alias("affected_component")))
    crit = (degradation.filter(F.col("degradation_detected"))
            .select(F.lit("critical").alias("alert_level"),
                    F.format_string("Model performance degradation detected. Probability change: %.1f%%",
                                    F.col("probability_change_pct")).alias("message"),
                    F.lit("model_performance").alias("affected_component")))
    return warn.unionByName(crit)


def alerts_by_severity(alerts_df: DataFrame, severity: str | None) -> DataFrame:
    return alerts_df if severity is None else alerts_df.filter(F.col("alert_level") == severity)


def monitoring_report(drift: DataFrame, degradation: DataFrame) -> DataFrame:
    """Long form (section, item, metric, value) of drift + performance."""
    dcols = ["baseline_mean", "current_mean", "mean_change_pct", "ks_statistic", "p_value", "drift_score"]
    d = drift.select("feature_name", *[F.col(c).cast("double") for c in dcols],
                     F.col("drift_detected").cast("double"))
    stack = ", ".join(f"'{c}', `{c}`" for c in [*dcols, "drift_detected"])
    dl = d.selectExpr("'drift' AS section", "feature_name AS item",
                      f"stack({len(dcols) + 1}, {stack}) AS (metric, value)")
    pcols = ["baseline_probability", "recent_probability", "probability_change_pct", "baseline_latency_ms",
             "recent_latency_ms", "latency_change_pct", "days_measured", "rows_measured", "degradation_detected"]
    p = degradation.select(*[F.col(c).cast("double").alias(c) for c in pcols])
    pstack = ", ".join(f"'{c}', `{c}`" for c in pcols)
    pl = p.selectExpr("'performance' AS section", "'model' AS item", f"stack({len(pcols)}, {pstack}) AS (metric, value)")
    return dl.unionByName(pl)


# --- outcomes, PSI, z-score, prediction drift, volume ----------------------------

def outcome_backfill(log: DataFrame, observations: DataFrame, window_days: int = 30) -> DataFrame:
    """Mark predictions in [observed_at - 30 d, observed_at] of an observed user as
    monitored and attach the actual label. ``observations``: (user_id, observed_at,
    actual_churned), at most one per user. Equi join on the user with a range
    residual; AQE splits a user that owns a large share of the log."""
    obs = observations.select("user_id", "observed_at", "actual_churned")
    j = log.join(obs, "user_id", "left")
    t = F.col("prediction_time")
    hit = (F.col("observed_at").isNotNull() & (t >= F.col("observed_at") - F.make_dt_interval(F.lit(window_days)))
           & (t <= F.col("observed_at")) & ~F.col("is_monitored"))
    return j.select(*[c for c in log.columns if c != "is_monitored"],
                    (F.col("is_monitored") | hit).alias("is_monitored"),
                    F.when(hit, F.col("actual_churned")).cast("int").alias("actual_label"))


def live_precision(backfilled: DataFrame) -> DataFrame:
    """Per version over monitored predictions: precision, recall, accuracy."""
    m = backfilled.filter(F.col("is_monitored") & F.col("actual_label").isNotNull())
    p, a = F.col("predicted_label"), F.col("actual_label")
    agg = m.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("n"), F.count_if((p == 1) & (a == 1)).alias("tp"),
        F.count_if((p == 1) & (a == 0)).alias("fp"), F.count_if((p == 0) & (a == 1)).alias("fn"),
        F.count_if(p == a).alias("correct"))
    return agg.select("model_version", "n", "tp", "fp", "fn",
                      F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                      F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
                      F.try_divide(F.col("correct"), F.col("n")).alias("accuracy"))


def psi(current: DataFrame, reference: DataFrame, features: Sequence[str] = S.MONITORED_FEATURES,
        bins: int = 10, floor: float = 1e-4) -> DataFrame:
    """Population stability index per feature with decile edges of the reference.

    Bin = number of edges strictly below the value; shares are floored at 1e-4.
    Edges are exact quantiles from distributed prefix sums; one small row of
    edges per feature.
    """
    fr = [round(i / bins, 10) for i in range(1, bins)]
    ref = long_features(reference, features)
    cur = long_features(current, features)
    q = ST.exact_quantiles(ref, ["feature_name"], "value", fr)
    edges = q.select("feature_name", F.array(*[F.col(f"q{i}") for i in range(len(fr))]).alias("edges"))

    def binned(lf: DataFrame, tag: str) -> DataFrame:
        b = lf.join(F.broadcast(edges), "feature_name").select(
            "feature_name", F.size(F.filter("edges", lambda e: e < F.col("value"))).alias("bin"))
        return b.groupBy("feature_name", "bin").agg(F.count(F.lit(1)).alias(tag))

    rb, cb = binned(ref, "n_ref"), binned(cur, "n_cur")
    grid = edges.select("feature_name", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    j = grid.join(rb, ["feature_name", "bin"], "left").join(cb, ["feature_name", "bin"], "left").fillna(0, ["n_ref", "n_cur"])
    tot = j.groupBy("feature_name").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    j = j.join(tot, "feature_name")
    e = F.greatest(F.coalesce(F.try_divide(F.col("n_ref"), F.col("t_ref")), F.lit(0.0)), F.lit(floor))
    a = F.greatest(F.coalesce(F.try_divide(F.col("n_cur"), F.col("t_cur")), F.lit(0.0)), F.lit(floor))
    out = j.groupBy("feature_name").agg(F.sum((a - e) * F.log(a / e)).alias("psi"))
    return out.withColumn("drift_detected", F.col("psi") > PSI_THRESHOLD)


def zscore_drift(current: DataFrame, baseline: DataFrame, features: Sequence[str] = S.MONITORED_FEATURES) -> DataFrame:
    """z = (current mean - baseline mean) / (baseline std / sqrt(n_current))."""
    m = drift_moments(current, features).select("feature_name", "n", "current_mean")
    b = baseline.select("feature_name", F.col("mean").alias("baseline_mean"), F.col("std").alias("baseline_std"))
    z = (F.col("current_mean") - F.col("baseline_mean")) / (F.col("baseline_std") / F.sqrt(F.col("n")))
    j = m.join(b, "feature_name").withColumn("z_score", F.when(F.col("baseline_std") > 0, z))
    return j.withColumn("drift_detected", F.coalesce(F.abs(F.col("z_score")) > ZSCORE_THRESHOLD, F.lit(False)))


def prediction_drift(log: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Per version: mean probability in the last ``days`` vs everything before."""
    lo = ts(str(as_of)[:10]) - F.make_dt_interval(F.lit(days))
    hi = ts(str(as_of)[:10])
    t = F.col("prediction_time")
    recent = (t >= lo) & (t < hi)
    agg = (log.filter(t < hi).groupBy("model_version")
           .agg(F.avg(F.when(~recent, F.col("churn_probability"))).alias("baseline_mean_probability"),
                F.avg(F.when(recent, F.col("churn_probability"))).alias("recent_mean_probability"),
                F.count_if(recent).alias("recent_n"), F.count_if(~recent).alias("baseline_n")))
    return (agg.withColumn("shift", F.col("recent_mean_probability") - F.col("baseline_mean_probability"))
            .withColumn("shift_pct", drift_mean_change(F.col("recent_mean_probability"),
                                                       F.col("baseline_mean_probability"))))


def prediction_volume(log: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Predictions whose day is within the last ``days`` days; > 10000 is a signal."""
    since = F.date_sub(_as_of_date(as_of), days)
    n = log.filter(_day(F.col("prediction_time")) >= since).agg(F.count(F.lit(1)).alias("predictions_7d"))
    return n.withColumn("volume_signal", F.col("predictions_7d") > VOLUME_THRESHOLD)


def schema_drift(log: DataFrame, expected: Sequence[str] = S.FEATURE_COLUMNS) -> DataFrame:
    """Per prediction day and expected feature: rows, rows whose JSON lacks the
    key, and rows where it is null."""
    day = _day(F.col("prediction_time")).alias("prediction_date")
    with_json = log.filter(F.col("features").isNotNull())
    rows = with_json.groupBy(day).agg(F.count(F.lit(1)).alias("n_rows"))
    as_map = F.from_json(F.col("features"), T.MapType(T.StringType(), T.StringType()))
    keys = (with_json.select(day, F.explode(as_map).alias("feature_name", "raw"))
            .groupBy("prediction_date", "feature_name")
            .agg(F.count(F.lit(1)).alias("n_present"), F.count_if(F.col("raw").isNull()).alias("n_null")))
    grid = rows.select("prediction_date", "n_rows",
                       F.explode(F.array(*[F.lit(c) for c in expected])).alias("feature_name"))
    j = grid.join(keys, ["prediction_date", "feature_name"], "left")
    return j.select("prediction_date", "feature_name", "n_rows",
                    (F.col("n_rows") - F.coalesce(F.col("n_present"), F.lit(0))).alias("rows_missing"),
                    F.coalesce(F.col("n_null"), F.lit(0)).alias("rows_null"))
