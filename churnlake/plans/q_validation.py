"""Registered validation / profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.functions.timefn import ts
from churnlake.operators import features as FE
from churnlake.operators import validate as V
from churnlake.plans import oracle_sql as O
from churnlake.plans.q_features import (
    SNAPSHOT_DATE_A,
    SNAPSHOT_DATE_B,
    STORE_N_A,
    STORE_START_A,
    STORE_STEP_A,
    TRAIN_N_B,
    TRAIN_START_B,
    TRAIN_STEP_B,
    _CUSTOM_SQL,
    custom_specs,
)
from churnlake.plans.registry import register
from churnlake.sources import schemas as S
from churnlake.sources.store import stored
from churnlake.sources.tables import Domain, mapping_a, mapping_b

CUSTOM_COLS = ("avg_amount_90d", "max_amount_90d", "min_amount_90d", "billing_rows_30d",
               "active_days_14d", "searches_7d")


# --- input frames -----------------------------------------------------------

def _profile_frame(spark, sf_dir):
    """Snapshot with the ten features and the declared custom features (has nulls)."""
    return FE.feature_snapshot(mapping_a(spark, sf_dir), SNAPSHOT_DATE_A, custom=custom_specs())


def _profile_cte() -> str:
    """SQL CTE list ending in ``frame``: the profile frame (features + custom)."""
    body = _CUSTOM_SQL
    head, tail = body.rsplit("\nSELECT s.user_id", 1)
    sel = ", ".join(f"s.{c}" for c in S.FEATURE_COLUMNS)
    tail = "SELECT s.user_id" + tail
    tail = tail.replace("SELECT s.user_id, s.feature_date,", f"SELECT s.user_id, s.feature_date, {sel},", 1)
    head = head.replace("snap AS (\n  SELECT u.user_id, g.feature_date\n",
                        "snap AS (\n  SELECT u.user_id, g.feature_date, "
                        + ", ".join(f"{O.FEATURE_SQL[f]} AS {f}" for f in S.FEATURE_COLUMNS) + "\n", 1)
    return head + ",\nframe AS (" + tail + ")"


def _ranges_frame(spark, sf_dir):
    return FE.feature_snapshot(mapping_a(spark, sf_dir), "2024-01-10")


_RANGES_CTE = O.grid_sql("A", "2024-01-10", 1, 1) + ",\nframe AS (SELECT * FROM snap)"


def _dup_frame(spark, sf_dir):
    """Weekly store with one date appended twice (append without dedupe)."""
    d = mapping_a(spark, sf_dir)
    grid = FE.feature_grid(d, FE.make_grid(STORE_START_A, STORE_N_A, STORE_STEP_A))
    return grid.unionByName(FE.feature_snapshot(d, "2024-01-15"))


_DUP_CTE = (O.grid_sql("A", STORE_START_A, STORE_N_A, STORE_STEP_A)
            + ",\nframe AS (SELECT * FROM snap UNION ALL SELECT * FROM snap WHERE feature_date = TIMESTAMP '2024-01-15')")


def _training(spark, sf_dir):
    return FE.training_dataset(mapping_b(spark, sf_dir), TRAIN_START_B, TRAIN_N_B, TRAIN_STEP_B)


_TRAIN_CTE = O.grid_sql("B", TRAIN_START_B, TRAIN_N_B, TRAIN_STEP_B, with_label=True, existing_only=True) \
    + ",\nframe AS (SELECT * FROM snap)"


# --- SQL builders ------------------------------------------------------------

def _null_counts_sql(cols) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS row_count "
        f"FROM frame" for c in cols)


_PROFILE_COLS = ("user_id", "feature_date") + S.FEATURE_COLUMNS + CUSTOM_COLS


@register("null_counts", _profile_cte() + "\n" + _null_counts_sql(_PROFILE_COLS))
def q_null_counts(spark, sf_dir):
    return V.null_counts(_profile_frame(spark, sf_dir))


@register("validate_nulls", _profile_cte() + ",\nnc AS (" + _null_counts_sql(_PROFILE_COLS) + """)
SELECT column_name, (null_count / row_count) AS null_ratio, null_count / row_count <= 1 - 0.95 AS passed
FROM nc""")
def q_validate_nulls(spark, sf_dir):
    return V.validate_nulls(_profile_frame(spark, sf_dir))


def _ranges_sql() -> str:
    parts = []
    for c, (lo, hi) in V.RANGE_RULES.items():
        cond = f"{c} < {float(lo)}" + (f" OR {c} > {float(hi)}" if hi != V.INF else "")
        hi_sql = "CAST(NULL AS DOUBLE)" if hi == V.INF else f"CAST({float(hi)} AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS column_name, CAST({float(lo)} AS DOUBLE) AS min_allowed, {hi_sql} AS max_allowed, "
                     f"count(*) FILTER (WHERE {cond}) AS violations FROM frame")
    return "\nUNION ALL ".join(parts)


@register("validate_ranges", _RANGES_CTE + ",\nr AS (" + _ranges_sql() + ")\nSELECT *, violations = 0 AS passed FROM r")
def q_validate_ranges(spark, sf_dir):
    """Ten range rules on a snapshot that keeps not-yet-signed-up users."""
    return V.validate_ranges(_ranges_frame(spark, sf_dir))


@register("validate_duplicates", _DUP_CTE + """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows, coalesce(sum(n - 1), 0) = 0 AS passed
FROM (SELECT user_id, feature_date, count(*) AS n FROM frame GROUP BY ALL)""")
def q_validate_duplicates(spark, sf_dir):
    return V.validate_duplicates(_dup_frame(spark, sf_dir))


@register("duplicate_users", _DUP_CTE + """
SELECT user_id, feature_date, count(*) AS n_rows FROM frame GROUP BY ALL HAVING count(*) > 1""")
def q_duplicate_users(spark, sf_dir):
    return V.duplicate_users(_dup_frame(spark, sf_dir))


def _stability_sql() -> str:
    means = ", ".join(f"avg({c}) AS {c}" for c in S.FEATURE_COLUMNS)
    rows = "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, stddev_samp({c}) AS std_of_means, avg({c}) AS mean_of_means FROM bd"
        for c in S.FEATURE_COLUMNS)
    return f""",
bd AS (SELECT feature_date, {means} FROM frame GROUP BY feature_date),
st AS ({rows})
SELECT column_name, (std_of_means) AS std_of_means, (mean_of_means) AS mean_of_means,
       (CASE WHEN mean_of_means > 0 THEN std_of_means / mean_of_means END) AS cv,
       coalesce(CASE WHEN mean_of_means > 0 THEN std_of_means / mean_of_means END <= 0.5, true) AS passed
FROM st"""


@register("validate_stability", _TRAIN_CTE + _stability_sql())
def q_validate_stability(spark, sf_dir):
    return V.validate_stability(_training(spark, sf_dir))


@register("validate_label_distribution", _TRAIN_CTE + """
SELECT (avg(churned_30d)) AS churn_rate, CAST(0.15 AS DOUBLE) AS expected_rate,
       avg(churned_30d) >= 0.05 AND avg(churned_30d) <= 0.95 AS passed FROM frame""")
def q_validate_label_distribution(spark, sf_dir):
    return V.validate_label_distribution(_training(spark, sf_dir))


@register("label_counts", _TRAIN_CTE + """
SELECT count(*) FILTER (WHERE churned_30d = 1) AS churned, count(*) FILTER (WHERE churned_30d = 0) AS retained,
       (avg(churned_30d)) AS churn_rate FROM frame""")
def q_label_counts(spark, sf_dir):
    return V.label_counts(_training(spark, sf_dir))


def _report_sql() -> str:
    nulls = " AND ".join(f"count(*) FILTER (WHERE {c} IS NULL) <= (1 - 0.95) * count(*)"
                         for c in ("user_id", "feature_date") + S.FEATURE_COLUMNS)
    ranges = " AND ".join(
        f"count(*) FILTER (WHERE {c} < {float(lo)}" + (f" OR {c} > {float(hi)}" if hi != V.INF else "") + ") = 0"
        for c, (lo, hi) in V.RANGE_RULES.items())
    stab = " AND ".join(
        f"coalesce(CASE WHEN avg({c}) > 0 THEN stddev_samp({c}) / avg({c}) END <= 0.5, true)"
        for c in S.FEATURE_COLUMNS)
    means = ", ".join(f"avg({c}) AS {c}" for c in S.FEATURE_COLUMNS)
    return f""",
bd AS (SELECT feature_date, {means} FROM frame GROUP BY feature_date),
checks AS (
  SELECT 'null_values' AS check_name, ({nulls}) AS passed FROM frame
  UNION ALL SELECT 'feature_ranges', ({ranges}) FROM frame
  UNION ALL SELECT 'duplicates', coalesce(sum(n - 1), 0) = 0
            FROM (SELECT user_id, feature_date, count(*) AS n FROM frame GROUP BY ALL)
  UNION ALL SELECT 'stability', ({stab}) FROM bd
  UNION ALL SELECT 'label_distribution', avg(churned_30d) BETWEEN 0.05 AND 0.95 FROM frame)
SELECT check_name, passed, CAST(sum(CAST(passed AS INTEGER)) OVER () AS BIGINT) AS checks_passed,
       count(*) OVER () AS checks_total FROM checks"""


@register("validation_report", _TRAIN_CTE + _report_sql())
def q_validation_report(spark, sf_dir):
    t = stored(_training(spark, sf_dir), "training")
    return V.validation_report(t.drop("churned_30d"), t.select("churned_30d"))


def _describe_sql() -> str:
    rows = "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS count, (avg({c})) AS mean, "
        f"(stddev_samp({c})) AS std, (CAST(min({c}) AS DOUBLE)) AS min, "
        f"(quantile_cont({c}, 0.25)) AS p25, (quantile_cont({c}, 0.5)) AS p50, "
        f"(quantile_cont({c}, 0.75)) AS p75, (CAST(max({c}) AS DOUBLE)) AS max FROM frame"
        for c in S.FEATURE_COLUMNS)
    return "\n" + rows


@register("feature_describe", _TRAIN_CTE + _describe_sql())
def q_feature_describe(spark, sf_dir):
    return V.feature_describe(_training(spark, sf_dir))


def _truncated(d: Domain, date: str) -> Domain:
    cut = ts(date)
    return Domain(d.users, d.user_events.filter(F.col("event_time") < cut),
                  d.billing_events.filter(F.col("event_time") < cut))


def _audit_sql() -> str:
    cut = f"TIMESTAMP '{SNAPSHOT_DATE_B}'"
    trunc_map = (O.MAPPING_B
                 .replace("FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey",
                          f"FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_shipdate < {cut}")
                 .replace("FROM orders WHERE o_totalprice >= 0",
                          f"FROM orders WHERE o_totalprice >= 0 AND o_orderdate < {cut}"))
    full = O.grid_sql("B", SNAPSHOT_DATE_B, 1, 1, with_label=True) + "\nSELECT * FROM snap"
    trunc = O.grid_sql(trunc_map, SNAPSHOT_DATE_B, 1, 1, with_label=True) + "\nSELECT * FROM snap"
    fcols = ", ".join(("user_id", "feature_date") + S.FEATURE_COLUMNS)
    return f"""WITH f AS ({full}), t AS ({trunc})
SELECT 'features' AS check_name, (SELECT count(*) FROM f) AS rows_checked,
       (SELECT count(*) FROM (SELECT {fcols} FROM f EXCEPT ALL SELECT {fcols} FROM t)) AS only_in_full,
       (SELECT count(*) FROM (SELECT {fcols} FROM t EXCEPT ALL SELECT {fcols} FROM f)) AS only_in_truncated
UNION ALL
SELECT 'label_control', (SELECT count(*) FROM f),
       (SELECT count(*) FROM (SELECT * FROM f EXCEPT ALL SELECT * FROM t)),
       (SELECT count(*) FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM f))"""


@register("pit_leakage_audit", _audit_sql())
def q_pit_leakage_audit(spark, sf_dir):
    """Features recomputed on facts cut at the date must be identical (0, 0);
    the forward-looking label is the control that must differ."""
    d = mapping_b(spark, sf_dir)
    full = FE.feature_snapshot(d, SNAPSHOT_DATE_B, with_label=True)
    trunc = FE.feature_snapshot(_truncated(d, SNAPSHOT_DATE_B), SNAPSHOT_DATE_B, with_label=True)
    feats = ["user_id", "feature_date", *S.FEATURE_COLUMNS]
    return (V.pit_leakage_audit(full.select(*feats), trunc.select(*feats), "features")
            .unionByName(V.pit_leakage_audit(full, trunc, "label_control")))
