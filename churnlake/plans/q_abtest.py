"""Registered A/B testing queries."""

from __future__ import annotations

from churnlake.functions import stats as ST
from churnlake.operators import abtest as AB
from churnlake.plans import oracle_sql as O
from churnlake.plans.registry import register
from churnlake.sources.predictions import (
    EXISTING_BEFORE,
    ab_assignments,
    ab_tests,
    ab_user_summary,
)
from churnlake.sources.tables import mapping_a

_TN = "'exp-' || CAST(user_id % 3 AS VARCHAR)"
_BUCKET = "CAST(('0x' || substring(md5(test_name || ':' || CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) % 10000"

TESTS_CTE = f"""tests AS (
  SELECT test_name, '1.0' AS control_version, '2.0' AS variant_version,
         CAST(CASE WHEN test_name = 'exp-1' THEN 0.3 ELSE 0.5 END AS DOUBLE) AS traffic_split,
         min(prediction_time) AS start_date, max(prediction_time) AS end_date,
         CAST(date_diff('day', CAST(min(prediction_time) AS DATE), CAST(max(prediction_time) AS DATE)) + 1 AS INTEGER)
           AS duration_days,
         CASE WHEN test_name = 'exp-2' THEN 'completed' ELSE 'active' END AS status
  FROM (SELECT {_TN} AS test_name, prediction_time FROM predictions) GROUP BY test_name)"""

AB_SQL = "WITH " + O.PREDICTIONS_CTE + ",\n" + TESTS_CTE + f""",
cand AS (SELECT user_id, {_TN} AS test_name, min(prediction_time) AS first_seen FROM predictions GROUP BY user_id),
bk AS (SELECT *, {_BUCKET} AS bucket FROM cand),
existing AS (
  SELECT user_id, test_name, CASE WHEN bucket >= 5000 THEN 'variant' ELSE 'control' END AS variant,
         '1.0' AS control_version, '2.0' AS variant_version, first_seen AS assigned_at
  FROM bk WHERE first_seen < TIMESTAMP '{EXISTING_BEFORE}'),
new AS (
  SELECT b.user_id, b.test_name,
         CASE WHEN t.status = 'active' AND b.bucket < t.traffic_split * 10000 THEN 'variant' ELSE 'control' END
           AS variant, t.control_version, t.variant_version, b.first_seen AS assigned_at
  FROM bk b JOIN tests t USING (test_name)
  WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.user_id = b.user_id AND e.test_name = b.test_name)),
assign AS (SELECT *, 'existing' AS source FROM existing UNION ALL SELECT *, 'new' AS source FROM new),
results AS (
  SELECT p.user_id, a.test_name, a.variant, p.churn_probability, p.latency_ms, p.prediction_time AS recorded_at
  FROM predictions p JOIN assign a USING (user_id)),
stats AS (
  SELECT test_name, variant, count(*) AS num_predictions, avg(churn_probability) AS avg_probability,
         stddev_samp(churn_probability) AS std_probability, avg(latency_ms) AS avg_latency,
         min(latency_ms) AS min_latency, max(latency_ms) AS max_latency
  FROM results GROUP BY ALL),
nv AS (SELECT test_name, count(*) AS n_variants FROM stats GROUP BY 1),
w0 AS (
  SELECT nv.test_name, nv.n_variants,
         c.num_predictions AS control_num_predictions, c.avg_probability AS control_avg_probability,
         c.std_probability AS control_std_probability, c.avg_latency AS control_avg_latency,
         c.min_latency AS control_min_latency, c.max_latency AS control_max_latency,
         v.num_predictions AS variant_num_predictions, v.avg_probability AS variant_avg_probability,
         v.std_probability AS variant_std_probability, v.avg_latency AS variant_avg_latency,
         v.min_latency AS variant_min_latency, v.max_latency AS variant_max_latency,
         n_variants >= 2 AND c.std_probability IS NOT NULL AND v.std_probability IS NOT NULL
           AND c.std_probability <> 0 AND v.std_probability <> 0
           AND c.num_predictions >= 2 AND v.num_predictions >= 2 AS ok,
         c.std_probability * c.std_probability / c.num_predictions AS a,
         v.std_probability * v.std_probability / v.num_predictions AS b
  FROM nv LEFT JOIN (SELECT * FROM stats WHERE variant = 'control') c USING (test_name)
          LEFT JOIN (SELECT * FROM stats WHERE variant = 'variant') v USING (test_name)),
welch AS (
  SELECT * EXCLUDE (ok, a, b),
         CASE WHEN ok THEN (control_avg_probability - variant_avg_probability) / sqrt(a + b) ELSE 0.0 END
           AS t_statistic,
         CASE WHEN ok THEN (a + b) * (a + b) / (a * a / (control_num_predictions - 1)
                                                 + b * b / (variant_num_predictions - 1)) END AS dof
  FROM w0)"""


@register("ab_tests_table", AB_SQL + "\nSELECT * FROM tests")
def q_ab_tests_table(spark, sf_dir):
    """The experiment table derived from the log (split, dates, status)."""
    return ab_tests(spark, sf_dir)


@register("ab_assign", AB_SQL + "\nSELECT * FROM assign")
def q_ab_assign(spark, sf_dir):
    """Sticky assignment: stored rows kept, the rest by md5 bucket and the stored
    split; the inactive test sends everyone to control."""
    return ab_assignments(spark, sf_dir)


@register("ab_variant_lookup", "WITH " + O.MAPPING_A + ",\n" + AB_SQL.replace("WITH ", "", 1) + """
SELECT u.user_id, a.variant FROM users u LEFT JOIN (SELECT * FROM assign WHERE test_name = 'exp-1') a USING (user_id)""")
def q_ab_variant_lookup(spark, sf_dir):
    """Variant of every user in test exp-1, null when unassigned."""
    users = mapping_a(spark, sf_dir).users
    return AB.variant_lookup(users, ab_assignments(spark, sf_dir), "exp-1")


def variant_stats(spark, sf_dir):
    """Per-variant statistics of the logged predictions under each user's
    assignment, from per-user partials (the join sees one row per user); the
    log is aggregated once and every A/B input derives from that."""
    summary = ab_user_summary(spark, sf_dir)
    return AB.results_by_variant_from_partials(summary, ab_assignments(spark, sf_dir, summary))


@register("ab_results", AB_SQL + "\nSELECT * FROM stats")
def q_ab_results(spark, sf_dir):
    return variant_stats(spark, sf_dir)


@register("ab_welch", AB_SQL + "\nSELECT * FROM welch")
def q_ab_welch(spark, sf_dir):
    """Control vs variant per test with Welch's t and degrees of freedom."""
    return AB.welch(variant_stats(spark, sf_dir))


_EXACT_P = f"(CASE WHEN dof IS NULL THEN 1.0 ELSE {ST.t_two_sided_pvalue_sql('t_statistic', 'dof')} END)"
_PW_SQL = AB_SQL + f""",
pw AS (SELECT *, {_EXACT_P} AS p_value FROM welch),
won AS (SELECT *, p_value < 0.05 AS significant,
               CASE WHEN n_variants < 2 THEN 'none'
                    WHEN variant_avg_probability < control_avg_probability AND p_value < 0.05 THEN 'variant'
                    ELSE 'control' END AS winner,
               CASE WHEN n_variants < 2 THEN 'insufficient_data' ELSE 'active' END AS status
        FROM pw)"""


@register("ab_pvalue", _PW_SQL + "\nSELECT test_name, t_statistic, dof, p_value FROM pw")
def q_ab_pvalue(spark, sf_dir):
    """Student-t two-sided p-value per test (vectorised UDF on one row per test)."""
    w = AB.with_pvalue(AB.welch(variant_stats(spark, sf_dir)))
    return w.select("test_name", "t_statistic", "dof", "p_value")


@register("ab_winner", _PW_SQL + "\nSELECT test_name, n_variants, t_statistic, dof, p_value, significant, winner, status"
          " FROM won")
def q_ab_winner(spark, sf_dir):
    w = AB.analyse(variant_stats(spark, sf_dir))
    return w.select("test_name", "n_variants", "t_statistic", "dof", "p_value", "significant", "winner", "status")


_NORMAL_P = f"(2.0 * (1.0 - {ST.normal_cdf_sql('abs(t_statistic)', '0.0', '1.0')}))"


@register("ab_winner_normal", AB_SQL + f""",
pw AS (SELECT *, CASE WHEN dof IS NULL THEN 1.0 ELSE {_NORMAL_P} END AS p_value FROM welch)
SELECT test_name, n_variants, t_statistic, dof, p_value, p_value < 0.05 AS significant,
       CASE WHEN n_variants < 2 THEN 'none'
            WHEN variant_avg_probability < control_avg_probability AND p_value < 0.05 THEN 'variant'
            ELSE 'control' END AS winner,
       CASE WHEN n_variants < 2 THEN 'insufficient_data' ELSE 'active' END AS status
FROM pw""")
def q_ab_winner_normal(spark, sf_dir):
    """Winner rule with the large-sample normal p-value (SQL-checkable form)."""
    w = AB.analyse(variant_stats(spark, sf_dir), exact=False)
    return w.select("test_name", "n_variants", "t_statistic", "dof", "p_value", "significant", "winner", "status")


@register("ab_all_tests", _PW_SQL + "\nSELECT * FROM won")
def q_ab_all_tests(spark, sf_dir):
    """Statistics, Welch test, exact p-value and winner for every test at once."""
    return AB.analyse(variant_stats(spark, sf_dir))


@register("ab_balance", AB_SQL + """,
agg AS (SELECT test_name, count(*) AS n_users, count(*) FILTER (WHERE variant = 'variant') AS n_variant
        FROM assign GROUP BY 1)
SELECT agg.*, t.traffic_split, t.status, n_variant / n_users AS realised_split,
       n_variant / n_users - t.traffic_split AS split_gap
FROM agg LEFT JOIN tests t USING (test_name)""")
def q_ab_balance(spark, sf_dir):
    return AB.balance(ab_assignments(spark, sf_dir), ab_tests(spark, sf_dir))
