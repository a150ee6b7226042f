"""Typed schemas of the raw and derived churn tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed domain values of the raw tables.
PLAN_TYPES = ("free", "basic", "pro")
EVENT_TYPES = ("login", "logout", "page_view", "search", "download", "upgrade", "downgrade")
BILLING_STATUSES = ("successful", "failed", "refunded")

USERS = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("plan_type", T.StringType(), True),
    T.StructField("signup_date", T.TimestampNTZType(), True),
    T.StructField("country", T.StringType(), True),
])

USER_EVENTS = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("event_time", T.TimestampNTZType(), True),
    T.StructField("session_id", T.StringType(), True),
])

BILLING_EVENTS = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("event_time", T.TimestampNTZType(), True),
])

FEATURES = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("feature_date", T.TimestampNTZType(), False),
    T.StructField("avg_sessions_7d", T.DoubleType(), True),
    T.StructField("sessions_30d", T.LongType(), True),
    T.StructField("days_since_last_login", T.IntegerType(), True),
    T.StructField("events_30d", T.LongType(), True),
    T.StructField("failed_payments_30d", T.LongType(), True),
    T.StructField("total_spend_90d", T.DoubleType(), True),
    T.StructField("refunds_30d", T.LongType(), True),
    T.StructField("is_pro_plan", T.IntegerType(), True),
    T.StructField("is_paid_plan", T.IntegerType(), True),
    T.StructField("days_since_signup", T.IntegerType(), True),
])

PREDICTIONS = T.StructType([
    T.StructField("prediction_id", T.LongType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("churn_probability", T.DoubleType(), True),
    T.StructField("predicted_label", T.IntegerType(), True),
    T.StructField("prediction_time", T.TimestampNTZType(), True),
    T.StructField("features", T.StringType(), True),
    T.StructField("model_version", T.StringType(), True),
    T.StructField("latency_ms", T.DoubleType(), True),
    T.StructField("from_cache", T.BooleanType(), True),
    T.StructField("is_monitored", T.BooleanType(), True),
])

# The ten catalogue features in model column order; the first seven are the
# numeric behaviour features the drift monitor watches.
FEATURE_COLUMNS = (
    "avg_sessions_7d", "sessions_30d", "days_since_last_login", "events_30d",
    "failed_payments_30d", "total_spend_90d", "refunds_30d",
    "is_pro_plan", "is_paid_plan", "days_since_signup",
)
MONITORED_FEATURES = FEATURE_COLUMNS[:7]
# The minimal feature set of the catalogue.
MINIMAL_FEATURES = ("avg_sessions_7d", "days_since_last_login", "total_spend_90d", "is_paid_plan")
