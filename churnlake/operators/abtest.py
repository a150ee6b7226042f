"""A/B testing: sticky hash assignment, per-variant statistics, Welch's t-test
(SURVEY §2.G). All tests are analysed at once, grouped by ``test_name``.

Assignment is a pure function of (test, user): bucket = first 32 bits of
md5("test:user") mod 10000, variant iff bucket < split * 10000. It is therefore
idempotent on replays and needs no coordination; existing assignments are kept
by an anti join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions import stats as ST

BUCKETS = 10000
ALPHA = 0.05


def hash_bucket(test_name: Column, user_id: Column) -> Column:
    h = F.md5(F.concat(test_name, F.lit(":"), user_id.cast("string")))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % F.lit(BUCKETS)).cast("long")


def assign_new(candidates: DataFrame, tests: DataFrame) -> DataFrame:
    """(user_id, test_name, first_seen) -> assignment by the stored split;
    an inactive test assigns everyone to control."""
    j = candidates.join(tests.select("test_name", "traffic_split", "status", "control_version", "variant_version"),
                        "test_name")
    in_variant = (F.col("status") == "active") & (
        hash_bucket(F.col("test_name"), F.col("user_id")) < F.col("traffic_split") * F.lit(BUCKETS))
    return j.select("user_id", "test_name",
                    F.when(in_variant, "variant").otherwise("control").alias("variant"),
                    "control_version", "variant_version", F.col("first_seen").alias("assigned_at"))


def sticky_assign(candidates: DataFrame, existing: DataFrame, tests: DataFrame) -> DataFrame:
    """Existing assignments are kept; only unseen (user, test) pairs are assigned."""
    fresh = candidates.join(existing.select("user_id", "test_name"), ["user_id", "test_name"], "left_anti")
    new = assign_new(fresh, tests).withColumn("source", F.lit("new"))
    return existing.withColumn("source", F.lit("existing")).unionByName(new)


def variant_lookup(requests: DataFrame, assignments: DataFrame, test_name: str) -> DataFrame:
    a = assignments.filter(F.col("test_name") == test_name).select("user_id", "variant")
    return requests.select("user_id").join(a, "user_id", "left")


def results_by_variant(results: DataFrame) -> DataFrame:
    """Per (test, variant): n, mean / sample std probability, latency stats."""
    return (results.groupBy("test_name", "variant")
            .agg(F.count(F.lit(1)).alias("num_predictions"),
                 F.avg("churn_probability").alias("avg_probability"),
                 F.stddev_samp("churn_probability").alias("std_probability"),
                 F.avg("latency_ms").alias("avg_latency"), F.min("latency_ms").alias("min_latency"),
                 F.max("latency_ms").alias("max_latency")))


def user_partials(log: DataFrame, extra=()) -> DataFrame:
    """Per user: count, mean and summed squared deviations (m2) of the
    probability, latency sum / min / max (plus ``extra`` aggregates). Combined
    map-side, so a user with a third of the log is one row per task before any
    shuffle."""
    return log.groupBy("user_id").agg(
        F.expr("count(1) AS n"), F.expr("count(churn_probability) AS np"), F.expr("avg(churn_probability) AS mean"),
        F.expr("var_pop(churn_probability) * count(churn_probability) AS m2"),
        F.expr("sum(latency_ms) AS ls"), F.expr("min(latency_ms) AS lmin"), F.expr("max(latency_ms) AS lmax"),
        *extra)


def results_by_variant_from_partials(partials: DataFrame, assignments: DataFrame) -> DataFrame:
    """``results_by_variant`` of (log joined to assignments on the user),
    computed from per-user partials: the join sees one row per user. Squared
    deviations are merged around the variant's own mean, in a second step, so a
    small spread around a large mean is not lost to cancellation."""
    p = partials.select("user_id", "n", "np", "mean", "m2", "ls", "lmin", "lmax")
    j = p.join(assignments.select("user_id", "test_name", "variant"), "user_id", "inner")
    keys = ["test_name", "variant"]
    g = j.groupBy(*keys).agg(
        F.expr("sum(n) AS num_predictions"), F.expr("sum(np) AS known"), F.expr("sum(np * mean) / sum(np) AS avg_probability"),
        F.expr("sum(ls) / sum(n) AS avg_latency"), F.expr("min(lmin) AS min_latency"),
        F.expr("max(lmax) AS max_latency"))
    spread = (j.join(g.select(*keys, "avg_probability"), keys).groupBy(*keys)
              .agg(F.expr("sum(m2 + np * (mean - avg_probability) * (mean - avg_probability)) AS m2")))
    return g.join(spread, keys).selectExpr(
        *keys, "num_predictions", "avg_probability",
        "CASE WHEN known > 1 THEN sqrt(m2 / (known - 1)) END AS std_probability",
        "avg_latency", "min_latency", "max_latency")


def welch(stats: DataFrame) -> DataFrame:
    """One row per test: control vs variant side by side, t and Welch df.

    The two variants are pivoted by one conditional aggregate per test (a single
    pass over the statistics, no self join). Guard (std 0 or null, n < 2): t = 0
    and df null, which the p-value maps to 1. A test without both variants gets
    ``n_variants < 2``."""
    cols = ["num_predictions", "avg_probability", "std_probability", "avg_latency", "min_latency", "max_latency"]
    aggs = [F.expr("count(1) AS n_variants")]
    for side in ("control", "variant"):
        aggs += [F.expr(f"max(CASE WHEN variant = '{side}' THEN {x} END) AS {side}_{x}") for x in cols]
    j = stats.groupBy("test_name").agg(*aggs)
    a = "(control_std_probability * control_std_probability / control_num_predictions)"
    b = "(variant_std_probability * variant_std_probability / variant_num_predictions)"
    ok = ("(n_variants >= 2 AND control_std_probability IS NOT NULL AND variant_std_probability IS NOT NULL "
          "AND control_std_probability != 0 AND variant_std_probability != 0 "
          "AND control_num_predictions >= 2 AND variant_num_predictions >= 2)")
    return j.selectExpr(
        "*",
        f"CASE WHEN {ok} THEN (control_avg_probability - variant_avg_probability) / sqrt({a} + {b}) "
        "ELSE 0.0D END AS t_statistic",
        f"CASE WHEN {ok} THEN ({a} + {b}) * ({a} + {b}) / ({a} * {a} / (control_num_predictions - 1) "
        f"+ {b} * {b} / (variant_num_predictions - 1)) END AS dof")


def with_pvalue(w: DataFrame, exact: bool = True) -> DataFrame:
    """p = 2 (1 - T_df(|t|)) (pandas UDF on one row per test); ``exact=False``
    uses the normal approximation 2 (1 - Phi(|t|)), which is plain SQL."""
    if exact:
        p = ST.t_two_sided_pvalue(F.col("t_statistic"), F.col("dof"))
    else:
        p = F.lit(2.0) * (F.lit(1.0) - ST.normal_cdf(F.abs(F.col("t_statistic")), F.lit(0.0), F.lit(1.0)))
    return w.withColumn("p_value", F.when(F.col("dof").isNull(), F.lit(1.0)).otherwise(p))


def winner(w: DataFrame) -> DataFrame:
    """variant iff it has the lower mean and p < 0.05; fewer than two variants
    -> insufficient_data."""
    better = (F.col("variant_avg_probability") < F.col("control_avg_probability")) & (F.col("p_value") < ALPHA)
    return (w.withColumn("significant", F.col("p_value") < ALPHA)
            .withColumn("winner", F.when(F.col("n_variants") < 2, "none")
                        .when(better, "variant").otherwise("control"))
            .withColumn("status", F.when(F.col("n_variants") < 2, "insufficient_data").otherwise("active")))


def all_tests(results: DataFrame, exact: bool = True) -> DataFrame:
    """Every test at once from raw result rows (test_name, variant, ...)."""
    return analyse(results_by_variant(results), exact)


def analyse(stats: DataFrame, exact: bool = True) -> DataFrame:
    """Welch test, p-value and winner from per-variant statistics."""
    return winner(with_pvalue(welch(stats), exact))


def balance(assignments: DataFrame, tests: DataFrame) -> DataFrame:
    """Realised variant share per test vs the configured split."""
    agg = assignments.groupBy("test_name").agg(F.count(F.lit(1)).alias("n_users"),
                                               F.count_if(F.col("variant") == "variant").alias("n_variant"))
    return (agg.join(tests.select("test_name", "traffic_split", "status"), "test_name", "left")
            .withColumn("realised_split", F.col("n_variant") / F.col("n_users"))
            .withColumn("split_gap", F.col("realised_split") - F.col("traffic_split")))
