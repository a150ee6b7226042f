"""Registered as-of, interval, carried-state and distinct-rollup queries."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from churnlake.operators import distinct as D
from churnlake.operators import features as FE
from churnlake.operators import scoring as SC
from churnlake.operators import state as ST
from churnlake.operators import timejoin as TJ
from churnlake.operators import validate as V
from churnlake.plans import oracle_sql as O
from churnlake.plans.q_features import STORE_N_A, STORE_START_A, STORE_STEP_A
from churnlake.plans.q_scoring import FIX_SQL, active_store
from churnlake.plans.q_streaming import _SESS_SQL, _activity
from churnlake.plans.registry import register
from churnlake.session import scratch_path
from churnlake.sources import store as SR
from churnlake.sources.predictions import prediction_log
from churnlake.sources.tables import mapping_a
from churnlake.streaming import jobs as J

_VECTOR = ("days_since_last_login", "events_30d", "total_spend_90d")


@register("prediction_asof_vectors", FIX_SQL + ",\n" + O.PREDICTIONS_CTE + f"""
SELECT p.prediction_id, p.user_id, p.prediction_time, v.feature_date AS vector_date, {", ".join(f"v.{c}" for c in _VECTOR)}
FROM predictions p ASOF LEFT JOIN st_snap v ON p.user_id = v.user_id AND p.prediction_time >= v.feature_date""")
def q_prediction_asof_vectors(spark, sf_dir):
    """Every prediction with the stored vector that was valid at its time."""
    log = prediction_log(spark, sf_dir).select("prediction_id", "user_id", "prediction_time")
    return TJ.asof_join(log, active_store(spark, sf_dir), ["user_id"], "prediction_time", "feature_date", _VECTOR,
                        matched="vector_date")


@register("prediction_sessions", _SESS_SQL + ",\n" + O.PREDICTIONS_CTE + """
SELECT p.prediction_id, p.user_id, s.session_start, s.session_end, s.events
FROM predictions p LEFT JOIN sess s ON s.user_id = p.user_id AND p.prediction_time >= s.session_start
  AND p.prediction_time < s.session_end""")
def q_prediction_sessions(spark, sf_dir):
    """Every prediction with the session in which it was made: an interval join on
    (user, hour)."""
    sessions = J.sessions_table(J.sessionize(_activity(spark, sf_dir))).drop("session_number")
    log = prediction_log(spark, sf_dir).select("prediction_id", "user_id", "prediction_time")
    return (TJ.interval_join(log, sessions, ["user_id"], "prediction_time", "session_start", "session_end", 3600, "left")
            .select("prediction_id", "user_id", "session_start", "session_end", "events"))


_CHAIN = [dt.date.fromisoformat(STORE_START_A) + dt.timedelta(days=STORE_STEP_A * k) for k in range(STORE_N_A)]


@register("snapshot_chain", O.grid_sql("A", STORE_START_A, STORE_N_A, STORE_STEP_A) + "\nSELECT * FROM snap")
def q_snapshot_chain(spark, sf_dir):
    """Weekly snapshots written one after the other, each from the login state that
    the one before left and the logins since; equal to the full-history form."""
    return ST.snapshot_chain(spark, mapping_a(spark, sf_dir), _CHAIN, scratch_path(spark, "chain"),
                             scratch_path(spark, "login-state"))


@register("distinct_users_rollup", "WITH " + O.PREDICTIONS_CTE + """,
p AS (SELECT CAST(prediction_time AS DATE) AS day, model_version, user_id FROM predictions)
SELECT CASE WHEN grouping(model_version) = 0 THEN 2 WHEN grouping(day) = 0 THEN 1 ELSE 0 END AS level,
       day, model_version, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users, CAST(count(*) AS BIGINT) AS n_rows
FROM p GROUP BY ROLLUP (day, model_version)""")
def q_distinct_users_rollup(spark, sf_dir):
    """Distinct users and predictions by day and version, by day and in total, from one aggregate."""
    log = prediction_log(spark, sf_dir).select(F.to_date("prediction_time").alias("day"), "model_version", "user_id")
    return D.rollup_ids(log, ["day", "model_version"], "user_id", "n_users")


@register("audited_publish", O.grid_sql("A", STORE_START_A, 2, STORE_STEP_A) + """,
good AS (SELECT * FROM snap WHERE feature_date = (SELECT max(feature_date) FROM snap))
SELECT *, (SELECT count(*) FROM snap WHERE feature_date = (SELECT min(feature_date) FROM snap)
           AND days_since_signup < 0) AS refused FROM good""")
def q_audited_publish(spark, sf_dir):
    """Two snapshots are staged and audited. The first holds users before their
    signup, which the range rule refuses, so nothing of it reaches the store;
    ``refused`` has the number of its bad rows. The second is published."""
    path, refused = scratch_path(spark, "audited"), 0
    for date in _CHAIN[:2]:
        snap = FE.feature_snapshot(mapping_a(spark, sf_dir), str(date))
        try:
            SR.write_audited(snap, path, V.audit_checks(snap.columns), unique=("user_id", "feature_date"))
        except SR.AuditFailed as e:
            refused += e.failures.get("range_days_since_signup", 0)
    return SR.read_store(spark, path).select(*snap.columns).withColumn("refused", F.lit(refused).cast("long"))


@register("bucketed_latest", FIX_SQL + "\nSELECT * FROM latest")
def q_bucketed_latest(spark, sf_dir):
    """The latest vectors merged week by week in tables bucketed by user: no join
    moves a row."""
    store = SR.stored(active_store(spark, sf_dir), "store")
    name = f"latest_{uuid.uuid4().hex}"  # tables of this run alone
    weeks = [SR.write_bucketed(SR.snapshot_for_date(store, str(date)), f"{name}_{k}", "user_id", 8)
             for k, date in enumerate(_CHAIN)]
    out = weeks[0]
    for k, week in enumerate(weeks[1:], 1):
        out = SR.write_bucketed(SC.latest_of(out, week), f"{name}_upto_{k}", "user_id", 8, dealt=True)
    return out
