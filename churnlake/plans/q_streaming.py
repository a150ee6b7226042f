"""Registered streaming queries. Each job lands its input (derived
from the test tables) as day files in a fresh folder under the checkpoint root,
runs the Structured Streaming query with ``availableNow``, lands the rest, runs
it again on the same sink and checkpoint, and returns the sink as a batch
DataFrame; the oracle is the batch result it must equal."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.plans import oracle_sql as O
from churnlake.plans.q_abtest import AB_SQL
from churnlake.plans.q_monitoring import _LOG_ONLY, _OBS_SQL, _observations
from churnlake.plans.q_scoring import FIX_SQL, active_store
from churnlake.plans.registry import register
from churnlake.session import scratch_path
from churnlake.sources.predictions import ab_existing, ab_tests, prediction_log
from churnlake.sources.tables import mapping_a, read_table
from churnlake.streaming import jobs as J

HALF = "2024-01-16"
DUP_FROM = "2024-01-20"


def _in_two_calls(spark, df, time_col, run):
    """Rows before ``HALF`` land and are processed, then the others: the second
    call goes on from the first one's sink and checkpoint."""
    landing, sink, ckpt = (scratch_path(spark, f"stream-{x}") for x in ("landing", "sink", "checkpoint"))
    cut = F.lit(HALF).cast("timestamp_ntz")
    out = None
    for half in (df.filter(F.col(time_col) < cut), df.filter(~(F.col(time_col) < cut))):
        J.write_landing(half, landing, F.to_date(time_col))
        out = run(landing, sink, ckpt)
    return out


@register("stream_ingest", "WITH " + O.PREDICTIONS_CTE + "\nSELECT *, CAST(NULL AS VARCHAR) AS features FROM predictions")
def q_stream_ingest(spark, sf_dir):
    """File-source ingest of the prediction log into a parquet sink."""
    log = prediction_log(spark, sf_dir)
    return _in_two_calls(spark, log, "prediction_time", lambda a, b, c: J.ingest(spark, a, log.schema, b, c))


@register("stream_hourly_metrics", _LOG_ONLY + "\nSELECT * FROM hourly")
def q_stream_hourly_metrics(spark, sf_dir):
    """Watermarked 1-hour windows per version, update mode into a changelog."""
    log = prediction_log(spark, sf_dir)
    return _in_two_calls(spark, log, "prediction_time", lambda a, b, c: J.streaming_hourly_metrics(
        spark, a, log.schema, b, c, watermark="1 day"))


@register("stream_late_events", _LOG_ONLY + f"""
SELECT *, (SELECT count(*) FROM predictions WHERE prediction_time < TIMESTAMP '{HALF}') AS late_rows
FROM hourly WHERE metric_date >= DATE '{HALF}'""")
def q_stream_late_events(spark, sf_dir):
    """Predictions from before 01-16 land after the rest: with a 1-day
    watermark they are late; the metrics cover the on-time days, and the late
    rows are counted."""
    log = prediction_log(spark, sf_dir)
    cut = F.lit(HALF).cast("timestamp_ntz")
    landing, sink, ckpt = (scratch_path(spark, f"late-{x}") for x in ("landing", "sink", "checkpoint"))
    df = None
    for part in (log.filter(F.col("prediction_time") >= cut), log.filter(F.col("prediction_time") < cut)):
        J.write_landing(part, landing, F.to_date("prediction_time"))
        df = J.streaming_hourly_metrics(spark, landing, log.schema, sink, ckpt, watermark="1 day")
    return df.withColumn("late_rows", F.lit(J.late_rows(spark, landing, log.schema, df)).cast("long"))


@register("stream_latest_vectors", FIX_SQL + "\nSELECT * FROM latest")
def q_stream_latest_vectors(spark, sf_dir):
    """Snapshots arrive in two deliveries; each is merged into the latest table."""
    store = active_store(spark, sf_dir)
    return _in_two_calls(spark, store, "feature_date", lambda a, b, c: J.streaming_latest_vectors(
        spark, a, store.schema, b, c))


def _third(log):
    """The fixture's candidates: user u takes part in test exp-(u % 3)."""
    return log.select("user_id", F.concat(F.lit("exp-"), (F.col("user_id") % 3).cast("string")).alias("test_name"),
                      F.col("prediction_time").alias("first_seen"))


@register("stream_ab_assign", AB_SQL + "\nSELECT user_id, test_name, variant, control_version, variant_version, source"
          " FROM assign")
def q_stream_ab_assign(spark, sf_dir):
    """Sticky assignment applied to each micro-batch of the log."""
    log = prediction_log(spark, sf_dir)
    out = _in_two_calls(spark, log, "prediction_time", lambda a, b, c: J.streaming_assign(
        spark, a, log.schema, ab_tests(spark, sf_dir), _third, ab_existing(spark, sf_dir), b, c))
    return out.select("user_id", "test_name", "variant", "control_version", "variant_version", "source")


@register("stream_sliding_activity", O.grid_sql("A", "2024-01-02", 60, 1, features=("events_30d",))
          + "\nSELECT user_id, feature_date, events_30d AS events FROM snap WHERE events_30d > 0")
def q_stream_sliding_activity(spark, sf_dir):
    """30-day windows sliding by a day per user; the window ending at d equals
    the events_30d feature at d."""
    ev = mapping_a(spark, sf_dir).user_events
    return _in_two_calls(spark, ev, "event_time", lambda a, b, c: J.streaming_sliding_counts(
        spark, a, ev.schema, b, c, watermark="1 day"))


def _activity(spark, sf_dir):
    """Every raw event is activity for sessionisation (the fixture has no session id)."""
    return read_table(spark, sf_dir, "events").select(F.col("user_id").cast("long").alias("user_id"),
                                                       F.col("ts").alias("event_time"))


_SESS_SQL = f"""WITH ev AS (SELECT CAST(user_id AS BIGINT) AS user_id, ts AS event_time FROM events),
g AS (SELECT *, CASE WHEN lag(event_time) OVER w IS NULL
                       OR date_sub('microsecond', lag(event_time) OVER w, event_time) > {J.SESSION_GAP_SECONDS * 1000000}
                     THEN 1 ELSE 0 END AS new FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY event_time)),
n AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS session_number
      FROM g),
sess AS (SELECT user_id, CAST(session_number AS BIGINT) AS session_number, min(event_time) AS session_start,
                max(event_time) + INTERVAL {J.SESSION_GAP_SECONDS} SECOND AS session_end, count(*) AS events
         FROM n GROUP BY ALL)"""


@register("sessionize", _SESS_SQL + "\nSELECT * FROM sess")
def q_sessionize(spark, sf_dir):
    """Batch sessions (a gap over 30 min starts a new one), split by hour chunks so
    a heavy user is spread over many tasks, then stitched."""
    return J.sessions_table(J.sessionize(_activity(spark, sf_dir)))


@register("stream_sessions", _SESS_SQL + "\nSELECT user_id, session_start, session_end, events FROM sess")
def q_stream_sessions(spark, sf_dir):
    """session_window(30 minutes) on the stream: final sessions from the sink,
    open ones from the rows that are in none."""
    ev = _activity(spark, sf_dir)
    return _in_two_calls(spark, ev, "event_time", lambda a, b, c: J.streaming_sessions(
        spark, a, ev.schema, b, c)).drop("closed")


@register("stream_dedupe", "WITH " + O.PREDICTIONS_CTE + "\nSELECT *, CAST(NULL AS VARCHAR) AS features FROM predictions")
def q_stream_dedupe(spark, sf_dir):
    """Days from 01-20 on are delivered twice; dropDuplicatesWithinWatermark on
    prediction_id restores the log."""
    log = prediction_log(spark, sf_dir)
    landing, sink, ckpt = (scratch_path(spark, f"dupes-{x}") for x in ("landing", "sink", "checkpoint"))
    again = log.filter(F.col("prediction_time") >= F.lit(DUP_FROM).cast("timestamp_ntz"))
    out = None
    for name, part in (("part", log), ("copy", again)):
        J.write_landing(part, landing, F.to_date("prediction_time"), name=name)
        out = J.streaming_dedupe(spark, landing, log.schema, ["prediction_id"], sink, ckpt)
    return out


@register("stream_outcomes", _OBS_SQL + "\nSELECT * FROM bf")
def q_stream_outcomes(spark, sf_dir):
    """Predictions joined on the stream with the outcomes of their users within 30
    days, in two deliveries of the log; equals the batch backfill."""
    log, seen = prediction_log(spark, sf_dir), _observations(spark, sf_dir)
    outcomes = scratch_path(spark, "stream-outcomes")
    J.write_landing(seen, outcomes, F.to_date("observed_at"))
    got = _in_two_calls(spark, log, "prediction_time", lambda a, b, c: J.streaming_outcomes(
        spark, a, log.schema, outcomes, seen.schema, b, c, watermark="31 days"))
    return got.drop("features")
