"""Registered feature / label / training-set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.operators import features as FE
from churnlake.plans import oracle_sql as O
from churnlake.plans.registry import register
from churnlake.sources import schemas as S
from churnlake.sources.tables import mapping_a, mapping_b

# Fixed parameters of the registered jobs.
SNAPSHOT_DATE_A = "2024-01-20"
SNAPSHOT_DATE_B = "1998-06-01"
TRAIN_START_B = "1998-01-05"
TRAIN_N_B = 12
TRAIN_STEP_B = 7
STORE_START_A = "2024-01-08"
STORE_N_A = 4
STORE_STEP_A = 7


def _one_feature(name: str):
    def job(spark, sf_dir):
        return FE.feature_snapshot(mapping_a(spark, sf_dir), SNAPSHOT_DATE_A, features=(name,))
    job.__name__ = f"feat_{name}"
    return job


for _f in S.FEATURE_COLUMNS:
    register(f"feat_{_f}", O.snapshot_sql("A", SNAPSHOT_DATE_A, features=(_f,)))(_one_feature(_f))


@register("feature_snapshot", O.snapshot_sql("A", SNAPSHOT_DATE_A))
def feature_snapshot(spark, sf_dir):
    """Flagship: ten features for every user as of one date (mapping A)."""
    return FE.feature_snapshot(mapping_a(spark, sf_dir), SNAPSHOT_DATE_A)


@register("feature_snapshot_b", O.snapshot_sql("B", SNAPSHOT_DATE_B))
def feature_snapshot_b(spark, sf_dir):
    """Ten features for every user at one date on the long-horizon mapping."""
    return FE.feature_snapshot(mapping_b(spark, sf_dir), SNAPSHOT_DATE_B)


@register("feature_snapshot_subset", O.snapshot_sql("A", SNAPSHOT_DATE_A, features=S.MINIMAL_FEATURES))
def feature_snapshot_subset(spark, sf_dir):
    """The MINIMAL feature set (column pruning removes the unused aggregates)."""
    return FE.feature_snapshot(mapping_a(spark, sf_dir), SNAPSHOT_DATE_A, features=S.MINIMAL_FEATURES)


_PURCHASERS_SQL = "u.user_id IN (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase')"


@register("features_for_users", O.snapshot_sql("A", SNAPSHOT_DATE_A, user_filter=_PURCHASERS_SQL))
def features_for_users(spark, sf_dir):
    """Features of a requested id set (every user with a purchase), by semi join."""
    from churnlake.sources.tables import read_table
    ids = (read_table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
           .select(F.col("user_id").cast("long").alias("user_id")))
    return FE.feature_snapshot(mapping_a(spark, sf_dir), SNAPSHOT_DATE_A, user_ids=ids)


_LABEL_SQL = (O.grid_sql("A", "2024-01-10", 1, 1, features=(), with_label=True)
              + "\nSELECT user_id, feature_date, churned_30d FROM snap")


@register("label_churned_30d", _LABEL_SQL)
def label_churned_30d(spark, sf_dir):
    """1 iff no activity and no successful payment in [d, d + 30 days)."""
    return FE.churn_labels(mapping_a(spark, sf_dir), "2024-01-10")


@register("snapshot_with_label", O.grid_sql("B", SNAPSHOT_DATE_B, 1, 1, with_label=True) + "\nSELECT * FROM snap")
def snapshot_with_label(spark, sf_dir):
    return FE.feature_snapshot(mapping_b(spark, sf_dir), SNAPSHOT_DATE_B, with_label=True)


TRAINING_SQL = O.grid_sql("B", TRAIN_START_B, TRAIN_N_B, TRAIN_STEP_B, with_label=True, existing_only=True)


@register("training_dataset", TRAINING_SQL + "\nSELECT * FROM snap")
def training_dataset(spark, sf_dir):
    """12 weekly snapshots with labels in one pass (mapping B)."""
    return FE.training_dataset(mapping_b(spark, sf_dir), TRAIN_START_B, TRAIN_N_B, TRAIN_STEP_B)


DAILY_SQL = O.grid_sql("A", "2024-01-02", 30, 1, with_label=True)


@register("training_dataset_daily", DAILY_SQL + "\nSELECT * FROM snap")
def training_dataset_daily(spark, sf_dir):
    """Daily snapshots over January 2024 (step 1 day, 90-day windows)."""
    return FE.feature_grid(mapping_a(spark, sf_dir), FE.make_grid("2024-01-02", 30, 1), with_label=True)


@register("training_summary", TRAINING_SQL + """
SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users, count(DISTINCT feature_date) AS n_dates,
       min(feature_date) AS min_date, max(feature_date) AS max_date, (avg(churned_30d)) AS churn_rate
FROM snap""")
def training_summary(spark, sf_dir):
    return FE.training_summary(FE.training_dataset(mapping_b(spark, sf_dir), TRAIN_START_B,
                                                   TRAIN_N_B, TRAIN_STEP_B))


def custom_specs():
    """A user-declared feature set on billing and activity."""
    paid = lambda: F.col("status") == "successful"
    return (
        FE.FeatureSpec("avg_amount_90d", "billing", "avg", "amount", paid, 90, None, "double"),
        FE.FeatureSpec("max_amount_90d", "billing", "max", "amount", paid, 90, None, "double"),
        FE.FeatureSpec("min_amount_90d", "billing", "min", "amount", paid, 90, None, "double"),
        FE.FeatureSpec("billing_rows_30d", "billing", "count", None, None, 30, 0, "long"),
        FE.FeatureSpec("active_days_14d", "events", "count_distinct", "session_id", None, 14, 0, "long"),
        FE.FeatureSpec("searches_7d", "events", "count", None, lambda: F.col("event_type") == "search", 7, 0, "long"),
    )


_CUSTOM_SQL = O.grid_sql("A", SNAPSHOT_DATE_A, 1, 1, features=(), extra_ctes=""",
cb AS (
  SELECT g.feature_date, e.user_id,
         avg(e.amount) FILTER (WHERE e.status = 'successful') AS avg_amount_90d,
         max(e.amount) FILTER (WHERE e.status = 'successful') AS max_amount_90d,
         min(e.amount) FILTER (WHERE e.status = 'successful') AS min_amount_90d,
         count(*) FILTER (WHERE e.event_time >= g.feature_date - INTERVAL 30 DAY) AS billing_rows_30d
  FROM dates g JOIN billing_events e
    ON e.event_time >= g.feature_date - INTERVAL 90 DAY AND e.event_time < g.feature_date
  GROUP BY ALL),
ce AS (
  SELECT g.feature_date, e.user_id,
         count(DISTINCT e.session_id) AS active_days_14d,
         count(*) FILTER (WHERE e.event_type = 'search' AND e.event_time >= g.feature_date - INTERVAL 7 DAY)
           AS searches_7d
  FROM dates g JOIN user_events e
    ON e.event_time >= g.feature_date - INTERVAL 14 DAY AND e.event_time < g.feature_date
  GROUP BY ALL)""") + """
SELECT s.user_id, s.feature_date, (cb.avg_amount_90d) AS avg_amount_90d,
       (cb.max_amount_90d) AS max_amount_90d, (cb.min_amount_90d) AS min_amount_90d,
       CAST(coalesce(cb.billing_rows_30d, 0) AS BIGINT) AS billing_rows_30d,
       CAST(coalesce(ce.active_days_14d, 0) AS BIGINT) AS active_days_14d,
       CAST(coalesce(ce.searches_7d, 0) AS BIGINT) AS searches_7d
FROM snap s LEFT JOIN cb ON cb.user_id = s.user_id LEFT JOIN ce ON ce.user_id = s.user_id"""


@register("custom_feature_spec", _CUSTOM_SQL)
def custom_feature_spec(spark, sf_dir):
    """Declared features (count / count_distinct / sum / avg / max / min over a window)."""
    return FE.feature_snapshot(mapping_a(spark, sf_dir), SNAPSHOT_DATE_A, features=(), custom=custom_specs())
