"""Registered monitoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.functions import stats as ST
from churnlake.operators import features as FE
from churnlake.operators import monitor as M
from churnlake.plans import oracle_sql as O
from churnlake.plans.registry import register
from churnlake.sources import schemas as S
from churnlake.sources.predictions import (
    AS_OF,
    LOG_GRID_DAYS,
    LOG_GRID_START,
    prediction_log,
    prediction_log_with_features,
    training_baseline_frame,
)
from churnlake.session import scratch_path
from churnlake.sources.store import stored, upsert_table, write_snapshots
from churnlake.sources.tables import mapping_a

FEATS = S.MONITORED_FEATURES
OBS_DATE = "2024-01-20"

# --- SQL fragments -------------------------------------------------------------

_VEC = ", ".join(f"s.{c}" for c in FEATS)
# predictions + the daily vectors (the log's feature JSON, already parsed)
PF_SQL = (O.grid_sql("A", LOG_GRID_START, LOG_GRID_DAYS, 1) + ",\n" + O.PREDICTIONS_CTE + f""",
pf AS (SELECT p.*, {_VEC} FROM predictions p
       LEFT JOIN snap s ON s.user_id = p.user_id AND s.feature_date = date_trunc('day', p.prediction_time))""")

_BASE_SNAP = O.grid_sql("A", "2024-01-03", 3, 7, prefix="bz_", with_mapping=False)


def _recent_where(as_of: str, days: int, alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return (f"{p}prediction_time >= TIMESTAMP '{as_of}' - INTERVAL {days} DAY AND {p}prediction_time < TIMESTAMP '{as_of}'"
            f" AND {p}avg_sessions_7d IS NOT NULL")


def _drift_ctes(as_of: str, days: int, tag: str) -> str:
    """CTEs (after PF_SQL and base) ending in rep_<tag>: the drift report."""
    ks_phi = ST.normal_cdf_sql("k.value", "k.b_mean", "k.b_std")
    return f""",
cur_{tag} AS (SELECT * FROM pf WHERE {_recent_where(as_of, days)}),
lc_{tag} AS ({O.long_sql(f'cur_{tag}', FEATS)}),
mom_{tag} AS (SELECT feature_name, count(*) AS n, avg(value) AS current_mean, stddev_pop(value) AS current_std,
                     min(value) AS min_value, max(value) AS max_value FROM lc_{tag} GROUP BY feature_name),
cnt_{tag} AS (SELECT feature_name, value, count(*) AS c FROM lc_{tag} GROUP BY ALL),
cum_{tag} AS (SELECT *, sum(c) OVER (PARTITION BY feature_name ORDER BY value ROWS UNBOUNDED PRECEDING) AS cum_c
              FROM cnt_{tag}),
ks_{tag} AS (SELECT k.feature_name, max(greatest(k.cum_c / m.n - {ks_phi}, {ks_phi} - (k.cum_c - k.c) / m.n))
                    AS ks_statistic, any_value(m.n) AS n
             FROM (SELECT c.*, bs.mean AS b_mean, bs.std AS b_std FROM cum_{tag} c JOIN bstats bs USING (feature_name)) k
             JOIN mom_{tag} m USING (feature_name) GROUP BY k.feature_name),
rep_{tag} AS (
  SELECT m.feature_name, m.n, m.current_mean, m.current_std, m.min_value, m.max_value,
         bs.mean AS baseline_mean, bs.std AS baseline_std, k.ks_statistic,
         {ST.kolmogorov_pvalue_sql('k.ks_statistic', 'CAST(k.n AS DOUBLE)')} AS p_value,
         abs((m.current_mean - bs.mean) / (abs(bs.mean) + 1e-6)) * 100.0 AS mean_change_pct
  FROM mom_{tag} m JOIN bstats bs USING (feature_name) JOIN ks_{tag} k USING (feature_name)),
drep_{tag} AS (SELECT *, p_value < 0.05 OR mean_change_pct > 30 AS drift_detected,
                      ks_statistic * 100.0 AS drift_score FROM rep_{tag})"""


BASE_SQL = f""",
{_BASE_SNAP},
lb AS ({O.long_sql('bz_snap', FEATS)}),
bstats AS (SELECT feature_name, avg(value) AS mean, stddev_samp(value) AS std, count(*) AS n FROM lb GROUP BY 1)"""

HOURLY_SQL = """hourly AS (
  SELECT CAST(prediction_time AS DATE) AS metric_date, CAST(hour(prediction_time) AS INTEGER) AS metric_hour,
         model_version, count(*) AS total_predictions,
         count(*) FILTER (WHERE predicted_label = 1) AS positive_predictions,
         count(*) FILTER (WHERE predicted_label = 0) AS negative_predictions,
         avg(churn_probability) AS avg_probability, avg(latency_ms) AS avg_latency_ms,
         count(*) FILTER (WHERE from_cache) / count(*) AS cache_hit_rate
  FROM predictions GROUP BY ALL)"""

_LOG_ONLY = "WITH " + O.PREDICTIONS_CTE + ",\n" + HOURLY_SQL


# --- Spark inputs ----------------------------------------------------------------

def _log(spark, sf_dir):
    return prediction_log(spark, sf_dir)


def _flog(spark, sf_dir):
    return prediction_log_with_features(spark, sf_dir)


def _current(spark, sf_dir, as_of=AS_OF, days=7):
    return stored(M.prediction_features(M.recent_predictions(_flog(spark, sf_dir), as_of, days)), "recent-features")


def _baseline(spark, sf_dir):
    return stored(M.baseline_statistics(training_baseline_frame(spark, sf_dir)), "baseline")


def _report(spark, sf_dir, as_of=AS_OF, days=7):
    return stored(M.drift_report(_current(spark, sf_dir, as_of, days), _baseline(spark, sf_dir)), "drift-report")


def _degradation(spark, sf_dir):
    return M.performance_degradation(M.hourly_metrics(_log(spark, sf_dir)), AS_OF)


# --- metrics ---------------------------------------------------------------------

@register("hourly_metrics", _LOG_ONLY + "\nSELECT * FROM hourly")
def q_hourly_metrics(spark, sf_dir):
    """Hourly metrics per (date, hour, version) for the whole month of the log."""
    return M.hourly_metrics(_log(spark, sf_dir))


@register("hourly_metrics_one_day", _LOG_ONLY + "\nSELECT * FROM hourly WHERE metric_date = DATE '2024-01-15'")
def q_hourly_metrics_one_day(spark, sf_dir):
    return M.hourly_metrics(_log(spark, sf_dir), "2024-01-15")


_DAILY_SQL = _LOG_ONLY + f""",
daily AS (SELECT metric_date, CAST(sum(total_predictions) AS BIGINT) AS total_predictions,
                 CAST(sum(positive_predictions) AS BIGINT) AS positive_predictions, avg(avg_probability) AS avg_probability,
                 avg(avg_latency_ms) AS avg_latency_ms, avg(cache_hit_rate) AS cache_hit_rate
          FROM hourly WHERE metric_date >= DATE '{AS_OF}' - INTERVAL 7 DAY GROUP BY metric_date)
SELECT *, CASE WHEN total_predictions > 0 THEN 100.0 * positive_predictions / total_predictions ELSE 0.0 END
          AS positive_rate FROM daily ORDER BY metric_date DESC"""


@register("daily_metrics", _DAILY_SQL)
def q_daily_metrics(spark, sf_dir):
    return M.daily_metrics(M.hourly_metrics(_log(spark, sf_dir)), AS_OF)


@register("positive_rate", _LOG_ONLY + """
SELECT metric_date, model_version, CAST(sum(positive_predictions) AS BIGINT) AS positive_predictions,
       CAST(sum(total_predictions) AS BIGINT) AS total_predictions,
       CASE WHEN sum(total_predictions) > 0 THEN 100.0 * sum(positive_predictions) / sum(total_predictions)
            ELSE 0.0 END AS positive_rate
FROM hourly GROUP BY ALL""")
def q_positive_rate(spark, sf_dir):
    d = (M.hourly_metrics(_log(spark, sf_dir)).groupBy("metric_date", "model_version")
         .agg(F.sum("positive_predictions").alias("positive_predictions"),
              F.sum("total_predictions").alias("total_predictions")))
    return d.withColumn("positive_rate", M.positive_rate(F.col("positive_predictions"), F.col("total_predictions")))


@register("metrics_rollup", _LOG_ONLY + """
SELECT metric_date, model_version, CAST(sum(total_predictions) AS BIGINT) AS total_predictions,
       CAST(sum(positive_predictions) AS BIGINT) AS positive_predictions
FROM hourly GROUP BY ROLLUP (metric_date, model_version)""")
def q_metrics_rollup(spark, sf_dir):
    return M.metrics_rollup(M.hourly_metrics(_log(spark, sf_dir)))


_UPSERT_SQL = _LOG_ONLY + """,
old AS (
  SELECT CAST(prediction_time AS DATE) AS metric_date, CAST(hour(prediction_time) AS INTEGER) AS metric_hour,
         model_version, count(*) AS total_predictions,
         count(*) FILTER (WHERE predicted_label = 1) AS positive_predictions,
         count(*) FILTER (WHERE predicted_label = 0) AS negative_predictions,
         avg(churn_probability) AS avg_probability, avg(latency_ms) AS avg_latency_ms,
         count(*) FILTER (WHERE from_cache) / count(*) AS cache_hit_rate
  FROM predictions WHERE from_cache AND prediction_time < TIMESTAMP '2024-01-20' GROUP BY ALL),
new AS (SELECT * FROM hourly WHERE metric_date >= DATE '2024-01-15')
SELECT * FROM new
UNION ALL
SELECT * FROM old o WHERE NOT EXISTS (
  SELECT 1 FROM new n WHERE n.metric_date = o.metric_date AND n.metric_hour = o.metric_hour
                        AND n.model_version = o.model_version)"""


@register("metrics_upsert", _UPSERT_SQL)
def q_metrics_upsert(spark, sf_dir):
    """A stored, stale cache-only metrics table before 01-20, upserted with a full
    recomputation from 01-15 on (key: date, hour, version) and read back."""
    log = _log(spark, sf_dir)
    old = M.hourly_metrics(log.filter(F.col("from_cache") & (F.col("prediction_time") < F.lit("2024-01-20")
                                                             .cast("timestamp_ntz"))))
    new = M.hourly_metrics(log).filter(F.col("metric_date") >= F.lit("2024-01-15").cast("date"))
    path = scratch_path(spark, "metrics")
    write_snapshots(old, path, ("metric_date",))
    return upsert_table(spark, path, new, ["metric_date", "metric_hour", "model_version"], "metric_date")


# --- features in the log, drift ----------------------------------------------------

@register("prediction_features", PF_SQL + "\nSELECT prediction_id, user_id, prediction_time, model_version, "
          + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATS) + " FROM pf")
def q_prediction_features(spark, sf_dir):
    """The log's feature JSON parsed into seven typed columns."""
    return M.prediction_features(_flog(spark, sf_dir))


@register("recent_predictions", PF_SQL + f"""
SELECT prediction_id, user_id, churn_probability, prediction_time, model_version FROM pf
WHERE {_recent_where(AS_OF, 7)}""")
def q_recent_predictions(spark, sf_dir):
    """Every prediction with features in the last 7 days."""
    return (M.recent_predictions(_flog(spark, sf_dir), AS_OF, 7)
            .select("prediction_id", "user_id", "churn_probability", "prediction_time", "model_version"))


@register("baseline_statistics", PF_SQL + BASE_SQL + "\nSELECT feature_name, mean, std, n FROM bstats")
def q_baseline_statistics(spark, sf_dir):
    return _baseline(spark, sf_dir)


_DRIFT = PF_SQL + BASE_SQL + _drift_ctes(AS_OF, 7, "w")


@register("drift_moments", _DRIFT + "\nSELECT feature_name, n, current_mean, current_std, min_value, max_value FROM mom_w")
def q_drift_moments(spark, sf_dir):
    return M.drift_moments(_current(spark, sf_dir))


@register("drift_ks", _DRIFT + "\nSELECT feature_name, n, ks_statistic, p_value FROM rep_w")
def q_drift_ks(spark, sf_dir):
    """Exact one-sample KS against the baseline normal, with asymptotic p-value."""
    return M.drift_ks(_current(spark, sf_dir), _baseline(spark, sf_dir))


@register("drift_mean_change", _DRIFT + "\nSELECT feature_name, baseline_mean, current_mean, mean_change_pct FROM rep_w")
def q_drift_mean_change(spark, sf_dir):
    base = _baseline(spark, sf_dir).select("feature_name", F.col("mean").alias("baseline_mean"))
    return (M.drift_moments(_current(spark, sf_dir)).join(base, "feature_name")
            .select("feature_name", "baseline_mean", "current_mean",
                    M.drift_mean_change(F.col("current_mean"), F.col("baseline_mean")).alias("mean_change_pct")))


_REPORT_COLS = ("feature_name", "n", "current_mean", "current_std", "min_value", "max_value", "baseline_mean",
                "baseline_std", "ks_statistic", "p_value", "mean_change_pct", "drift_detected", "drift_score")


@register("drift_flags", _DRIFT + "\nSELECT " + ", ".join(_REPORT_COLS) + " FROM drep_w")
def q_drift_flags(spark, sf_dir):
    return _report(spark, sf_dir).select(*_REPORT_COLS)


_REF_SQL = f"""
SELECT * FROM pf WHERE prediction_time >= TIMESTAMP '2024-01-01' AND prediction_time < TIMESTAMP '2024-01-15'
  AND avg_sessions_7d IS NOT NULL"""


@register("ks_two_sample", _DRIFT + f""",
ref AS ({_REF_SQL}),
lr AS ({O.long_sql('ref', FEATS)}),
u AS (SELECT feature_name, value, 1 AS c1, 0 AS c2 FROM lc_w UNION ALL SELECT feature_name, value, 0, 1 FROM lr),
cnt AS (SELECT feature_name, value, sum(c1) AS c1, sum(c2) AS c2 FROM u GROUP BY ALL),
cum AS (SELECT *, sum(c1) OVER w AS cum1, sum(c2) OVER w AS cum2 FROM cnt
        WINDOW w AS (PARTITION BY feature_name ORDER BY value ROWS UNBOUNDED PRECEDING)),
tot AS (SELECT feature_name, CAST(sum(c1) AS BIGINT) AS n1, CAST(sum(c2) AS BIGINT) AS n2 FROM cnt GROUP BY 1),
d AS (SELECT feature_name, n1, n2, max(abs(cum1 / n1 - cum2 / n2)) AS ks_statistic FROM cum JOIN tot USING (feature_name)
      GROUP BY ALL)
SELECT feature_name, n1, n2, ks_statistic,
       {ST.kolmogorov_pvalue_sql('ks_statistic', 'CAST(n1 * n2 AS DOUBLE) / (n1 + n2)')} AS p_value FROM d""")
def q_ks_two_sample(spark, sf_dir):
    """Last week's logged features vs the first two weeks' rows, per feature."""
    flog = M.prediction_features(_flog(spark, sf_dir))
    ref = flog.filter((F.col("prediction_time") >= F.lit("2024-01-01").cast("timestamp_ntz"))
                      & (F.col("prediction_time") < F.lit("2024-01-15").cast("timestamp_ntz"))
                      & F.col("avg_sessions_7d").isNotNull())
    out = M.ks_two_sample(_current(spark, sf_dir), ref)
    return out.select("feature_name", "n1", "n2", "ks_statistic", "p_value")


_DRIFT_ROW = ("CAST(DATE '{d}' AS DATE) AS check_date, feature_name, current_mean AS mean_value, "
              "current_std AS std_value, min_value, max_value, drift_detected, drift_score, "
              "printf('Mean change: %.1f%%', mean_change_pct) AS notes")


@register("drift_log", PF_SQL + BASE_SQL + _drift_ctes(AS_OF, 7, "w") + _drift_ctes(AS_OF, 3, "s")
          + _drift_ctes("2024-01-24", 7, "p") + f""",
old AS (SELECT {_DRIFT_ROW.format(d='2024-01-31')} FROM drep_s
        UNION ALL SELECT {_DRIFT_ROW.format(d='2024-01-24')} FROM drep_p),
new AS (SELECT {_DRIFT_ROW.format(d='2024-01-31')} FROM drep_w)
SELECT * FROM new UNION ALL
SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.check_date = o.check_date
                                                           AND n.feature_name = o.feature_name)""")
def q_drift_log(spark, sf_dir):
    """data_drift upsert: an earlier 3-day check for 01-31 and a check for 01-24,
    then the 7-day check for 01-31 replaces its day's rows."""
    old = (M.drift_rows(_report(spark, sf_dir, AS_OF, 3), AS_OF)
           .unionByName(M.drift_rows(_report(spark, sf_dir, "2024-01-24", 7), "2024-01-24")))
    path = scratch_path(spark, "drift-log")
    M.drift_log(spark, path, old)
    return M.drift_log(spark, path, M.drift_rows(_report(spark, sf_dir, AS_OF, 7), AS_OF))


_DEGR_SQL = HOURLY_SQL + f""",
agg AS (
  SELECT avg(avg_probability) FILTER (WHERE metric_date < DATE '{AS_OF}' - INTERVAL 14 DAY) AS baseline_probability,
         avg(avg_latency_ms) FILTER (WHERE metric_date < DATE '{AS_OF}' - INTERVAL 14 DAY) AS baseline_latency_ms,
         avg(avg_probability) FILTER (WHERE metric_date >= DATE '{AS_OF}' - INTERVAL 7 DAY) AS recent_probability,
         avg(avg_latency_ms) FILTER (WHERE metric_date >= DATE '{AS_OF}' - INTERVAL 7 DAY) AS recent_latency_ms,
         count(DISTINCT metric_date) FILTER (WHERE metric_date >= DATE '{AS_OF}' - INTERVAL 7 DAY) AS days_measured,
         count(*) FILTER (WHERE metric_date >= DATE '{AS_OF}' - INTERVAL 7 DAY) AS rows_measured
  FROM hourly),
chg AS (
  SELECT *, CASE WHEN baseline_probability IS NOT NULL AND baseline_probability <> 0
                 THEN (baseline_probability - recent_probability) / baseline_probability * 100.0 ELSE 0.0 END
              AS probability_change_pct,
            CASE WHEN baseline_latency_ms IS NOT NULL AND baseline_latency_ms <> 0
                 THEN (recent_latency_ms - baseline_latency_ms) / baseline_latency_ms * 100.0 ELSE 0.0 END
              AS latency_change_pct
  FROM agg),
degr AS (
  SELECT *, CASE WHEN baseline_probability IS NULL OR recent_probability IS NULL THEN false
                 ELSE probability_change_pct > 10 OR latency_change_pct > 50 END AS degradation_detected,
            CASE WHEN baseline_probability IS NULL OR recent_probability IS NULL THEN 'insufficient_data'
                 WHEN probability_change_pct > 10 OR latency_change_pct > 50 THEN 'degraded' ELSE 'ok' END AS status
  FROM chg)"""


@register("performance_degradation", "WITH " + O.PREDICTIONS_CTE + ",\n" + _DEGR_SQL + "\nSELECT * FROM degr")
def q_performance_degradation(spark, sf_dir):
    return _degradation(spark, sf_dir)


_ALERTS_SQL = _DRIFT + ",\n" + _DEGR_SQL + """,
alerts AS (
  SELECT 'warning' AS alert_level,
         printf('Data drift detected in %s (%.1f%% change)', feature_name, mean_change_pct) AS message,
         feature_name AS affected_component FROM drep_w WHERE drift_detected
  UNION ALL
  SELECT 'critical', printf('Model performance degradation detected. Probability change: %.1f%%',
                            probability_change_pct), 'model_performance' FROM degr WHERE degradation_detected)"""


@register("alerts", _ALERTS_SQL + "\nSELECT * FROM alerts")
def q_alerts(spark, sf_dir):
    return M.alerts(_report(spark, sf_dir), _degradation(spark, sf_dir))


@register("alerts_by_severity", _ALERTS_SQL + "\nSELECT * FROM alerts WHERE alert_level = 'warning'")
def q_alerts_by_severity(spark, sf_dir):
    return M.alerts_by_severity(M.alerts(_report(spark, sf_dir), _degradation(spark, sf_dir)), "warning")


def _report_sql() -> str:
    dcols = ("baseline_mean", "current_mean", "mean_change_pct", "ks_statistic", "p_value", "drift_score")
    parts = [f"SELECT 'drift' AS section, feature_name AS item, '{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM drep_w"
             for c in dcols]
    parts.append("SELECT 'drift', feature_name, 'drift_detected', CAST(CAST(drift_detected AS INTEGER) AS DOUBLE) "
                 "FROM drep_w")
    pcols = ("baseline_probability", "recent_probability", "probability_change_pct", "baseline_latency_ms",
             "recent_latency_ms", "latency_change_pct", "days_measured", "rows_measured")
    parts += [f"SELECT 'performance', 'model', '{c}', CAST({c} AS DOUBLE) FROM degr" for c in pcols]
    parts.append("SELECT 'performance', 'model', 'degradation_detected', "
                 "CAST(CAST(degradation_detected AS INTEGER) AS DOUBLE) FROM degr")
    return _ALERTS_SQL + "\n" + "\nUNION ALL ".join(parts)


@register("monitoring_report", _report_sql())
def q_monitoring_report(spark, sf_dir):
    return M.monitoring_report(_report(spark, sf_dir), _degradation(spark, sf_dir))


# --- outcomes, PSI, z-score, prediction drift, volume, schema ------------------------

def _observations(spark, sf_dir):
    lab = FE.churn_labels(mapping_a(spark, sf_dir), OBS_DATE)
    return lab.select("user_id", F.col("feature_date").alias("observed_at"), F.col("churned_30d").alias("actual_churned"))


_OBS_SQL = (O.grid_sql("A", OBS_DATE, 1, 1, features=(), with_label=True) + ",\n" + O.PREDICTIONS_CTE + """,
obs AS (SELECT user_id, feature_date AS observed_at, churned_30d AS actual_churned FROM snap),
bf AS (
  SELECT p.prediction_id, p.user_id, p.churn_probability, p.predicted_label, p.prediction_time, p.model_version,
         p.latency_ms, p.from_cache,
         p.is_monitored OR coalesce(o.observed_at IS NOT NULL AND p.prediction_time >= o.observed_at - INTERVAL 30 DAY
                                    AND p.prediction_time <= o.observed_at AND NOT p.is_monitored, false) AS is_monitored,
         CAST(CASE WHEN o.observed_at IS NOT NULL AND p.prediction_time >= o.observed_at - INTERVAL 30 DAY
                        AND p.prediction_time <= o.observed_at AND NOT p.is_monitored
                   THEN o.actual_churned END AS INTEGER) AS actual_label
  FROM predictions p LEFT JOIN obs o ON o.user_id = p.user_id)""")


@register("outcome_backfill", _OBS_SQL + "\nSELECT * FROM bf")
def q_outcome_backfill(spark, sf_dir):
    """Predictions up to 30 days before a user's observation get the actual label."""
    return M.outcome_backfill(_log(spark, sf_dir).drop("features"), _observations(spark, sf_dir))


@register("live_precision", _OBS_SQL + """
SELECT model_version, count(*) AS n,
       count(*) FILTER (WHERE predicted_label = 1 AND actual_label = 1) AS tp,
       count(*) FILTER (WHERE predicted_label = 1 AND actual_label = 0) AS fp,
       count(*) FILTER (WHERE predicted_label = 0 AND actual_label = 1) AS fn,
       CASE WHEN count(*) FILTER (WHERE predicted_label = 1) > 0 THEN
         count(*) FILTER (WHERE predicted_label = 1 AND actual_label = 1) / count(*) FILTER (WHERE predicted_label = 1)
       END AS precision,
       CASE WHEN count(*) FILTER (WHERE actual_label = 1) > 0 THEN
         count(*) FILTER (WHERE predicted_label = 1 AND actual_label = 1) / count(*) FILTER (WHERE actual_label = 1)
       END AS recall,
       count(*) FILTER (WHERE predicted_label = actual_label) / count(*) AS accuracy
FROM bf WHERE is_monitored AND actual_label IS NOT NULL GROUP BY model_version""")
def q_live_precision(spark, sf_dir):
    return M.live_precision(M.outcome_backfill(_log(spark, sf_dir).drop("features"), _observations(spark, sf_dir)))


def _psi_sql() -> str:
    fr = ", ".join(str(round(i / 10, 10)) for i in range(1, 10))
    return _DRIFT + f""",
edges AS (SELECT feature_name, quantile_cont(value, [{fr}]) AS edges FROM lb GROUP BY 1),
rb AS (SELECT l.feature_name, len(list_filter(e.edges, lambda x: x < l.value)) AS bin, count(*) AS n_ref
       FROM lb l JOIN edges e USING (feature_name) GROUP BY ALL),
cb AS (SELECT l.feature_name, len(list_filter(e.edges, lambda x: x < l.value)) AS bin, count(*) AS n_cur
       FROM lc_w l JOIN edges e USING (feature_name) GROUP BY ALL),
g AS (SELECT feature_name, bin FROM edges, range(0, 10) r(bin)),
j AS (SELECT g.feature_name, g.bin, coalesce(rb.n_ref, 0) AS n_ref, coalesce(cb.n_cur, 0) AS n_cur
      FROM g LEFT JOIN rb USING (feature_name, bin) LEFT JOIN cb USING (feature_name, bin)),
t AS (SELECT feature_name, sum(n_ref) AS t_ref, sum(n_cur) AS t_cur FROM j GROUP BY 1),
s AS (SELECT j.feature_name, greatest(n_ref / t_ref, 1e-4) AS e, greatest(n_cur / t_cur, 1e-4) AS a
      FROM j JOIN t USING (feature_name))
SELECT feature_name, sum((a - e) * ln(a / e)) AS psi, sum((a - e) * ln(a / e)) > 0.1 AS drift_detected
FROM s GROUP BY feature_name"""


@register("psi", _psi_sql())
def q_psi(spark, sf_dir):
    """PSI of last week's logged features against the training rows' deciles."""
    return M.psi(_current(spark, sf_dir), stored(training_baseline_frame(spark, sf_dir), "training-rows"))


@register("zscore_drift", _DRIFT + """
SELECT m.feature_name, m.n, m.current_mean, bs.mean AS baseline_mean, bs.std AS baseline_std,
       CASE WHEN bs.std > 0 THEN (m.current_mean - bs.mean) / (bs.std / sqrt(m.n)) END AS z_score,
       coalesce(abs(CASE WHEN bs.std > 0 THEN (m.current_mean - bs.mean) / (bs.std / sqrt(m.n)) END) > 3, false)
         AS drift_detected
FROM mom_w m JOIN bstats bs USING (feature_name)""")
def q_zscore_drift(spark, sf_dir):
    return M.zscore_drift(_current(spark, sf_dir), _baseline(spark, sf_dir))


@register("prediction_drift", "WITH " + O.PREDICTIONS_CTE + f""",
x AS (SELECT *, prediction_time >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AS recent FROM predictions
      WHERE prediction_time < TIMESTAMP '{AS_OF}'),
agg AS (SELECT model_version, avg(churn_probability) FILTER (WHERE NOT recent) AS baseline_mean_probability,
               avg(churn_probability) FILTER (WHERE recent) AS recent_mean_probability,
               count(*) FILTER (WHERE recent) AS recent_n, count(*) FILTER (WHERE NOT recent) AS baseline_n
        FROM x GROUP BY 1)
SELECT *, recent_mean_probability - baseline_mean_probability AS shift,
       abs((recent_mean_probability - baseline_mean_probability) / (abs(baseline_mean_probability) + 1e-6)) * 100.0
         AS shift_pct FROM agg""")
def q_prediction_drift(spark, sf_dir):
    return M.prediction_drift(_log(spark, sf_dir), AS_OF)


@register("prediction_volume_7d", "WITH " + O.PREDICTIONS_CTE + f"""
SELECT count(*) AS predictions_7d, count(*) > 10000 AS volume_signal FROM predictions
WHERE CAST(prediction_time AS DATE) >= DATE '{AS_OF}' - INTERVAL 7 DAY""")
def q_prediction_volume_7d(spark, sf_dir):
    return M.prediction_volume(_log(spark, sf_dir), AS_OF)


def _schema_drift_sql() -> str:
    names = ", ".join(f"('{c}')" for c in S.FEATURE_COLUMNS)
    obj = ", ".join(f"'{c}', {c}" for c in FEATS)
    return PF_SQL + f""",
js AS (SELECT CAST(prediction_time AS DATE) AS prediction_date, json_object({obj}) AS features FROM pf
       WHERE avg_sessions_7d IS NOT NULL),
rows AS (SELECT prediction_date, count(*) AS n_rows FROM js GROUP BY 1),
keys AS (SELECT prediction_date, k AS feature_name, count(*) AS n_present,
                count(*) FILTER (WHERE json_extract(features, '$.' || k) IS NULL
                                    OR json_type(json_extract(features, '$.' || k)) = 'NULL') AS n_null
         FROM (SELECT prediction_date, features, unnest(json_keys(features)) AS k FROM js) GROUP BY ALL),
names AS (SELECT * FROM (VALUES {names}) v(feature_name))
SELECT r.prediction_date, n.feature_name, r.n_rows, r.n_rows - coalesce(k.n_present, 0) AS rows_missing,
       coalesce(k.n_null, 0) AS rows_null
FROM rows r JOIN names n ON true
LEFT JOIN keys k ON k.prediction_date = r.prediction_date AND k.feature_name = n.feature_name"""


@register("schema_drift", _schema_drift_sql())
def q_schema_drift(spark, sf_dir):
    """Per day and model feature: logged vectors lacking the key (the log keeps
    seven of the ten model features)."""
    return M.schema_drift(_flog(spark, sf_dir))
