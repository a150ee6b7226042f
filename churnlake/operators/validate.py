"""Validation and profiling of feature frames.

Every check is one aggregate over the whole frame (map-side combined) whose
result is unpivoted to rows with ``stack``; nothing is pulled to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.sources import schemas as S

NULL_THRESHOLD = 0.95
STABILITY_TOLERANCE = 0.5
EXPECTED_CHURN_RATE = 0.15
INF = float("inf")

# Fixed values: (min, max) range rules of the ten catalogue features.
RANGE_RULES = {
    "avg_sessions_7d": (0, INF),
    "sessions_30d": (0, INF),
    "days_since_last_login": (0, 9999),
    "events_30d": (0, INF),
    "failed_payments_30d": (0, INF),
    "total_spend_90d": (0, INF),
    "refunds_30d": (0, INF),
    "is_pro_plan": (0, 1),
    "is_paid_plan": (0, 1),
    "days_since_signup": (0, INF),
}


def _stack(df: DataFrame, names: Sequence[str], fields: Sequence[str], key: str = "column_name") -> DataFrame:
    """Unpivot aggregate columns named ``{name}__{field}`` to one row per name."""
    parts = []
    for n in names:
        parts.append(f"'{n}'")
        parts += [f"`{n}__{f}`" for f in fields]
    return df.selectExpr(f"stack({len(names)}, {', '.join(parts)}) AS ({key}, {', '.join(fields)})")


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, null_count, row_count)."""
    cols = df.columns
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}__null_count") for c in cols],
                 *[F.count(F.lit(1)).alias(f"{c}__row_count") for c in cols])
    return _stack(agg, cols, ("null_count", "row_count"))


def validate_nulls(df: DataFrame, threshold: float = NULL_THRESHOLD) -> DataFrame:
    """(column_name, null_ratio, passed): a column fails if its null share
    exceeds ``1 - threshold``."""
    nc = null_counts(df)
    ratio = F.try_divide(F.col("null_count"), F.col("row_count"))
    return nc.select("column_name", ratio.alias("null_ratio"),
                     (ratio <= F.lit(1 - threshold)).alias("passed"))


def validate_ranges(df: DataFrame, rules: dict = RANGE_RULES) -> DataFrame:
    """(column_name, min_allowed, max_allowed, violations, passed); a null
    ``max_allowed`` means no upper bound."""
    present = [c for c in rules if c in df.columns]
    aggs = []
    for c in present:
        lo, hi = rules[c]
        bad = F.col(c) < F.lit(float(lo))
        if hi != INF:
            bad = bad | (F.col(c) > F.lit(float(hi)))
        aggs.append(F.count_if(bad).alias(f"{c}__violations"))
        aggs.append(F.lit(float(lo)).alias(f"{c}__min_allowed"))
        aggs.append(F.lit(None if hi == INF else float(hi)).cast("double").alias(f"{c}__max_allowed"))
    out = _stack(df.agg(*aggs), present, ("min_allowed", "max_allowed", "violations"))
    return out.withColumn("passed", F.col("violations") == 0)


def audit_checks(columns: Sequence[str], threshold: float = NULL_THRESHOLD, rules: dict = RANGE_RULES,
                 label: str = "churned_30d") -> dict:
    """The row checks of a feature frame for ``store.write_audited``: nulls beyond
    ``1 - threshold`` of a column, values outside their range, labels that are
    neither 0 nor 1."""
    out = {f"null_{c}": (F.col(c).isNull(), 1 - threshold) for c in columns}
    for c in (c for c in rules if c in columns):
        lo, hi = rules[c]
        bad = F.col(c) < F.lit(float(lo))
        out[f"range_{c}"] = (bad if hi == INF else bad | (F.col(c) > F.lit(float(hi))), 0.0)
    if label in columns:
        out["label"] = (F.col(label).isNull() | ~F.col(label).isin(0, 1), 0.0)
    return out


def duplicate_users(df: DataFrame, keys: Sequence[str] = ("user_id", "feature_date")) -> DataFrame:
    """Keys that appear more than once, with their multiplicity."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def validate_duplicates(df: DataFrame, keys: Sequence[str] = ("user_id", "feature_date")) -> DataFrame:
    """One row: rows beyond the first per key, and whether there are none."""
    d = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
         .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_rows")))
    return d.withColumn("passed", F.col("duplicate_rows") == 0)


def validate_stability(df: DataFrame, features: Sequence[str] | None = None,
                       tolerance: float = STABILITY_TOLERANCE) -> DataFrame:
    """Per feature: sample std of the per-date means over their mean (only when
    that mean is > 0); fails when above ``tolerance``."""
    feats = [c for c in (features or S.FEATURE_COLUMNS) if c in df.columns]
    by_date = df.groupBy("feature_date").agg(*[F.avg(c).alias(c) for c in feats])
    agg = by_date.agg(*[F.stddev_samp(c).alias(f"{c}__std_of_means") for c in feats],
                      *[F.avg(c).alias(f"{c}__mean_of_means") for c in feats])
    out = _stack(agg, feats, ("std_of_means", "mean_of_means"))
    cv = F.when(F.col("mean_of_means") > 0, F.try_divide(F.col("std_of_means"), F.col("mean_of_means")))
    return (out.withColumn("cv", cv)
            .withColumn("passed", F.coalesce(F.col("cv") <= F.lit(tolerance), F.lit(True))))


def label_counts(labels: DataFrame, label: str = "churned_30d") -> DataFrame:
    return labels.agg(F.count_if(F.col(label) == 1).alias("churned"),
                      F.count_if(F.col(label) == 0).alias("retained"),
                      F.avg(label).alias("churn_rate"))


def validate_label_distribution(labels: DataFrame, expected: float = EXPECTED_CHURN_RATE,
                                label: str = "churned_30d") -> DataFrame:
    """Churn rate, expected rate, and whether the rate is within [5 %, 95 %]."""
    rate = F.avg(label)
    return labels.agg(rate.alias("churn_rate")).select(
        "churn_rate", F.lit(expected).alias("expected_rate"),
        ((F.col("churn_rate") >= 0.05) & (F.col("churn_rate") <= 0.95)).alias("passed"))


def validation_report(features: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(check_name, passed, checks_passed, checks_total) for the full validation."""
    checks = [
        validate_nulls(features).agg(F.bool_and("passed").alias("passed"))
        .select(F.lit("null_values").alias("check_name"), "passed"),
        validate_ranges(features).agg(F.bool_and("passed").alias("passed"))
        .select(F.lit("feature_ranges").alias("check_name"), "passed"),
        validate_duplicates(features).select(F.lit("duplicates").alias("check_name"), "passed"),
        validate_stability(features).agg(F.bool_and("passed").alias("passed"))
        .select(F.lit("stability").alias("check_name"), "passed"),
    ]
    if labels is not None:
        checks.append(validate_label_distribution(labels)
                      .select(F.lit("label_distribution").alias("check_name"), "passed"))
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    # The report has one row per check (at most five): a global window is fine.
    w = Window.partitionBy(F.lit(0))
    return (out.withColumn("checks_passed", F.sum(F.col("passed").cast("int")).over(w).cast("long"))
            .withColumn("checks_total", F.count(F.lit(1)).over(w)))


def feature_describe(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles, max per feature.

    Moments come from one global aggregate; the quartiles are exact (linear
    interpolation) from distributed prefix sums over the distinct values, so no
    task ever holds a column's values."""
    from churnlake.functions.stats import exact_quantiles

    feats = [c for c in (features or S.FEATURE_COLUMNS) if c in df.columns]
    aggs = []
    for c in feats:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    moments = _stack(df.agg(*aggs), feats, ("count", "mean", "std", "min", "max"))
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in feats)
    long = df.selectExpr(f"stack({len(feats)}, {stack}) AS (column_name, value)")
    q = exact_quantiles(long, ["column_name"], "value", [0.25, 0.5, 0.75]).selectExpr(
        "column_name", "q0 AS p25", "q1 AS p50", "q2 AS p75")
    return (moments.join(q, "column_name", "left")
            .select("column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def pit_leakage_audit(full: DataFrame, truncated: DataFrame, name: str) -> DataFrame:
    """Rows that differ between a snapshot computed on all facts and one computed
    on facts cut at the snapshot date; both counts must be 0 for a PIT-correct
    feature set."""
    tagged = (full.exceptAll(truncated).select(F.lit("f").alias("t"))
              .unionByName(truncated.exceptAll(full).select(F.lit("t").alias("t")))
              .unionByName(full.select(F.lit("c").alias("t"))))
    return tagged.agg(F.lit(name).alias("check_name"),
                      F.count_if(F.col("t") == "c").alias("rows_checked"),
                      F.count_if(F.col("t") == "f").alias("only_in_full"),
                      F.count_if(F.col("t") == "t").alias("only_in_truncated"))
