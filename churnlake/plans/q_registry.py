"""Registered registry / retraining queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.operators import features as FE
from churnlake.operators import monitor as M
from churnlake.operators import registry as R
from churnlake.plans import oracle_sql as O
from churnlake.plans.q_abtest import TESTS_CTE
from churnlake.plans.q_monitoring import _ALERTS_SQL, _degradation, _report
from churnlake.plans.registry import register
from churnlake.sources.predictions import AS_OF, ab_tests, of_logged_users, prediction_log
from churnlake.sources import registry_fixture as RF
from churnlake.sources.store import stored
from churnlake.sources.tables import mapping_a

LABEL_GRID_START = "2024-01-01"
LABEL_GRID_DAYS = 32


def scored_log(spark, sf_dir):
    """Log rows with the actual outcome: was the user inactive the next day?"""
    log = prediction_log(spark, sf_dir)
    lab = (FE.feature_grid(of_logged_users(mapping_a(spark, sf_dir), log),
                           FE.make_grid(LABEL_GRID_START, LABEL_GRID_DAYS, 1),
                           features=(), with_label=True, label_days=1)
           .select("user_id", "feature_date", F.col("churned_30d").alias("actual_label")))
    log = log.withColumn(
        "feature_date", (F.date_trunc("DAY", F.col("prediction_time")) + F.make_dt_interval(F.lit(1))).cast("timestamp_ntz"))
    return log.join(lab, ["user_id", "feature_date"], "left").drop("feature_date")


def versions(spark, sf_dir):
    return RF.weekly_versions(scored_log(spark, sf_dir))


def status(spark, sf_dir):
    return R.version_status(R.candidate_gate(versions(spark, sf_dir)), AS_OF)


def promo_log(spark, sf_dir):
    return RF.promotions(status(spark, sf_dir))


def reg_body(snap: str) -> str:
    """Registry CTEs (sl ... promo) over a label grid CTE named ``snap``."""
    return f"""sl AS (SELECT p.*, s.churned_30d AS actual_label,
              'churn-' || p.model_version AS model_name, date_trunc('week', p.prediction_time) AS training_date
       FROM predictions p LEFT JOIN {snap} s
         ON s.user_id = p.user_id AND s.feature_date = date_trunc('day', p.prediction_time) + INTERVAL 1 DAY),
cnt AS (SELECT model_name, training_date, count(*) AS training_samples,
               count(*) FILTER (WHERE predicted_label = 1 AND actual_label = 1) AS tp,
               count(*) FILTER (WHERE predicted_label = 1 AND actual_label = 0) AS fp,
               count(*) FILTER (WHERE predicted_label = 0 AND actual_label = 1) AS fn,
               avg(churn_probability) AS avg_probability FROM sl GROUP BY ALL),
sc AS (SELECT model_name, training_date, churn_probability AS s,
              count(*) FILTER (WHERE actual_label = 1) AS pos, count(*) FILTER (WHERE actual_label = 0) AS neg
       FROM sl GROUP BY ALL),
scu AS (SELECT *, sum(neg) OVER (PARTITION BY model_name, training_date ORDER BY s ROWS UNBOUNDED PRECEDING) AS cum_neg
        FROM sc),
aucs AS (SELECT model_name, training_date,
                CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                     THEN sum(pos * ((cum_neg - neg) + 0.5 * neg)) / (sum(pos) * sum(neg)) END AS auc
         FROM scu GROUP BY ALL),
ver AS (
  SELECT c.model_name, c.model_name || '.' || strftime(c.training_date, '%Y%m%d') AS version, c.training_date,
         c.training_samples, c.avg_probability, a.auc,
         CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS precision,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS recall
  FROM cnt c LEFT JOIN aucs a USING (model_name, training_date)),
verm AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall) END AS f1
         FROM ver),
g0 AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY training_date) AS step,
              coalesce(abs(avg_probability - avg(avg_probability) OVER (PARTITION BY model_name))
                / abs(avg(avg_probability) OVER (PARTITION BY model_name)) * 100.0 > 10.0, false) AS drift_reason
       FROM verm),
walk AS (
  SELECT g.model_name, g.step, g.version, g.training_date, g.auc, NULL::VARCHAR AS prod_version,
         NULL::DOUBLE AS prod_auc, coalesce(g.auc, 0.0) AS auc_improvement,
         coalesce(g.precision, 0.0) AS precision_improvement, coalesce(g.recall, 0.0) AS recall_improvement,
         g.drift_reason, 'first model' AS reason, true AS accepted,
         g.version AS now_version, g.auc AS now_auc, g.precision AS now_precision, g.recall AS now_recall
  FROM g0 g WHERE g.step = 1
  UNION ALL
  SELECT model_name, step, version, training_date, auc, prod_version, prod_auc, gain, pgain, rgain, drift_reason,
         reason, reason <> 'no gain',
         CASE WHEN reason <> 'no gain' THEN version ELSE prod_version END,
         CASE WHEN reason <> 'no gain' THEN auc ELSE prod_auc END,
         CASE WHEN reason <> 'no gain' THEN precision ELSE prod_precision END,
         CASE WHEN reason <> 'no gain' THEN recall ELSE prod_recall END
  FROM (SELECT *, CASE WHEN gain > 0.01 THEN 'auc gain' WHEN gain >= -0.005 AND drift_reason THEN 'drift'
                       ELSE 'no gain' END AS reason
        FROM (SELECT g.*, w.now_version AS prod_version, w.now_auc AS prod_auc, w.now_precision AS prod_precision,
                     w.now_recall AS prod_recall, coalesce(g.auc, 0.0) - coalesce(w.now_auc, 0.0) AS gain,
                     coalesce(g.precision, 0.0) - coalesce(w.now_precision, 0.0) AS pgain,
                     coalesce(g.recall, 0.0) - coalesce(w.now_recall, 0.0) AS rgain
              FROM walk w JOIN g0 g ON g.model_name = w.model_name AND g.step = w.step + 1))),
gate AS (SELECT model_name, version, training_date, auc, prod_version, prod_auc, auc_improvement,
                precision_improvement, recall_improvement, drift_reason, reason, accepted FROM walk),
st0 AS (SELECT *, accepted AND NOT (training_date >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY) AS old_acc,
               training_date >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AS recent FROM gate),
st AS (SELECT * EXCLUDE (old_acc, recent, rk),
              CASE WHEN NOT accepted THEN 'failed' WHEN recent THEN 'staging' WHEN rk = 1 THEN 'production'
                   ELSE 'deprecated' END AS status
       FROM (SELECT *, row_number() OVER (PARTITION BY model_name, old_acc ORDER BY training_date DESC) AS rk FROM st0)),
base AS (
  SELECT model_name, version, 'candidate' AS from_status, 'staging' AS to_status,
         training_date + INTERVAL 1 DAY AS promoted_at FROM st WHERE accepted
  UNION ALL SELECT model_name, version, 'candidate', 'failed', training_date + INTERVAL 1 DAY FROM st WHERE NOT accepted
  UNION ALL SELECT model_name, version, 'staging', 'production', training_date + INTERVAL 2 DAY FROM st
            WHERE status IN ('production', 'deprecated')),
dep AS (SELECT model_name, version, 'production' AS from_status, 'deprecated' AS to_status, next_at AS promoted_at
        FROM (SELECT *, lead(promoted_at) OVER (PARTITION BY model_name ORDER BY promoted_at) AS next_at
              FROM base WHERE to_status = 'production') WHERE next_at IS NOT NULL),
promo AS (SELECT * FROM base UNION ALL SELECT * FROM dep)"""


REG_SQL = (O.grid_sql("A", LABEL_GRID_START, LABEL_GRID_DAYS, 1, features=(), with_label=True, label_days=1)
           + ",\n" + O.PREDICTIONS_CTE + ",\n" + reg_body("snap")).replace("WITH", "WITH RECURSIVE", 1)


@register("model_versions", REG_SQL + """
SELECT model_name, version, training_date, training_samples, avg_probability FROM verm""")
def q_model_versions(spark, sf_dir):
    """Weekly versions of each model line, derived from the prediction log."""
    return versions(spark, sf_dir).drop("metrics_json")


@register("model_metrics_json", REG_SQL + "\nSELECT model_name, version, training_date, auc, precision, recall, f1 FROM verm")
def q_model_metrics_json(spark, sf_dir):
    """The versions' metrics JSON parsed into columns."""
    return R.metrics_columns(versions(spark, sf_dir))


@register("candidate_gate", REG_SQL + "\nSELECT * FROM gate")
def q_candidate_gate(spark, sf_dir):
    return R.candidate_gate(versions(spark, sf_dir))


@register("version_status", REG_SQL + "\nSELECT * FROM st")
def q_version_status(spark, sf_dir):
    return status(spark, sf_dir)


@register("promotion_log", REG_SQL + "\nSELECT * FROM promo")
def q_promotion_log(spark, sf_dir):
    return promo_log(spark, sf_dir)


_LEGAL = ", ".join(f"('{a}', '{b}')" for a, b in R.LEGAL_TRANSITIONS)


@register("promotion_audit", REG_SQL + f""",
legal AS (SELECT * FROM (VALUES {_LEGAL}) v(from_status, to_status)),
plog AS (SELECT * FROM promo UNION ALL
         SELECT model_name, version, 'failed', 'production', promoted_at + INTERVAL 3 DAY FROM promo
         WHERE to_status = 'failed'),
disp AS (SELECT model_name, version, lag(version) OVER (PARTITION BY model_name ORDER BY promoted_at) AS displaced_version
         FROM plog WHERE to_status = 'production')
SELECT p.from_status, p.to_status, p.model_name, p.version, p.promoted_at,
       EXISTS (SELECT 1 FROM legal l WHERE l.from_status = p.from_status AND l.to_status = p.to_status) AS is_legal,
       CASE WHEN p.to_status = 'production' THEN d.displaced_version END AS displaced_version
FROM plog p LEFT JOIN disp d USING (model_name, version)""")
def q_promotion_audit(spark, sf_dir):
    """The audit of a log in which failed versions went to production."""
    return R.promotion_audit(RF.with_skipped_steps(promo_log(spark, sf_dir)))


@register("production_model", REG_SQL + """,
top AS (SELECT model_name, version, promoted_at FROM promo WHERE to_status = 'production'
        QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY promoted_at DESC, version DESC) = 1)
SELECT t.* FROM top t JOIN st s ON s.model_name = t.model_name AND s.version = t.version AND s.status = 'production'""")
def q_production_model(spark, sf_dir):
    return R.production_model(status(spark, sf_dir), promo_log(spark, sf_dir))


@register("model_history", REG_SQL + """
SELECT model_name, version, training_date, status, auc, recency FROM (
  SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY training_date DESC, version DESC) AS recency FROM st)
WHERE recency <= 3""")
def q_model_history(spark, sf_dir):
    return R.model_history(status(spark, sf_dir), k=3).withColumn("recency", F.col("recency").cast("long"))


@register("staging_models", REG_SQL + """
SELECT model_name, version, training_date, auc FROM st WHERE status = 'staging' ORDER BY training_date DESC""")
def q_staging_models(spark, sf_dir):
    return R.staging_models(status(spark, sf_dir))


_SIGNALS_SQL = _ALERTS_SQL + f""",
vol AS (SELECT count(*) AS predictions_7d, count(*) > 10000 AS volume_signal FROM predictions
        WHERE CAST(prediction_time AS DATE) >= DATE '{AS_OF}' - INTERVAL 7 DAY),
dr AS (SELECT count(*) FILTER (WHERE drift_detected) AS drift_count,
              coalesce(array_to_string(list_sort(list(feature_name) FILTER (WHERE drift_detected)), ','), '')
                AS drifted_features FROM drep_w),
signals AS (
  SELECT CAST(CAST((dr.drift_count > 0) AS INTEGER) + CAST((degr.status = 'degraded') AS INTEGER)
           + CAST(vol.volume_signal AS INTEGER) AS BIGINT) AS signals,
         dr.drift_count, dr.drifted_features, degr.status = 'degraded' AS degradation_detected,
         vol.predictions_7d, vol.volume_signal
  FROM dr, degr, vol),
sig AS (SELECT *, signals >= 1 AS should_retrain FROM signals)"""


@register("retraining_signals", _SIGNALS_SQL + "\nSELECT * FROM sig")
def q_retraining_signals(spark, sf_dir):
    """Drift, degradation and volume signals and the retraining decision."""
    return _signals(spark, sf_dir, _report(spark, sf_dir), _degradation(spark, sf_dir))


def _signals(spark, sf_dir, report, degradation):
    return R.retraining_signals(report, degradation, M.prediction_volume(prediction_log(spark, sf_dir), AS_OF))


_DASH_SQL = (_SIGNALS_SQL.replace("WITH", "WITH RECURSIVE", 1) + ",\n"
             + O.grid_sql("A", LABEL_GRID_START, LABEL_GRID_DAYS, 1, features=(), with_label=True, label_days=1,
                          prefix="rg_", with_mapping=False)
             + ",\n" + reg_body("rg_snap") + ",\n" + TESTS_CTE + """
SELECT (SELECT count(*) FROM st WHERE status = 'production') AS production_models,
       (SELECT count(*) FROM st WHERE status = 'staging') AS staging_models,
       (SELECT count(*) FROM tests WHERE status = 'active') AS active_tests,
       (SELECT count(*) FROM alerts) AS alerts,
       (SELECT should_retrain FROM sig) AS should_retrain""")


@register("dashboard_summary", _DASH_SQL)
def q_dashboard_summary(spark, sf_dir):
    """Production / staging counts, active tests, retraining flag, alert count."""
    report, degradation = _report(spark, sf_dir), stored(_degradation(spark, sf_dir), "degradation")
    sig = _signals(spark, sf_dir, report, degradation)
    return R.dashboard_summary(stored(status(spark, sf_dir), "status"), ab_tests(spark, sf_dir), sig,
                               M.alerts(report, degradation))
