"""Loads and load-time checks: insert-if-absent, row counts, domain rules,
referential integrity (SURVEY §2.A)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.sources import schemas as S
from churnlake.sources.tables import Domain


def dedupe_keep_first(df: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """One row per key: the smallest by ``order_by`` (deterministic).

    Done as an aggregate (``min_by`` of a struct), which combines map-side, so a
    key repeated in a third of the batch never lands whole in one task.
    """
    others = [c for c in df.columns if c != key]
    packed = F.struct(*[F.col(c) for c in others])
    order = F.struct(*[F.col(c) for c in order_by]) if len(order_by) > 1 else F.col(order_by[0])
    return (df.groupBy(key).agg(F.min_by(packed, order).alias("_row"))
            .select(key, *[F.col(f"_row.{c}").alias(c) for c in others]))


def new_rows_ignoring_conflicts(target: DataFrame, incoming: DataFrame, key: str,
                                order_by: list[str]) -> DataFrame:
    """Rows of ``incoming`` whose key is absent from ``target`` (ON CONFLICT DO NOTHING);
    duplicate keys inside the batch keep the first row by ``order_by``."""
    fresh = dedupe_keep_first(incoming, key, order_by)
    return fresh.join(target.select(key), key, "left_anti")


def insert_ignore(target: DataFrame, incoming: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """The target after the load: existing rows untouched plus the new keys."""
    return target.unionByName(new_rows_ignoring_conflicts(target, incoming, key, order_by))


def append_load(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Batch append of fact rows (the writer splits files; no row paging)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def table_row_counts(d: Domain) -> DataFrame:
    """(table_name, row_count) for the three raw tables, one union of global counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in (("users", d.users), ("user_events", d.user_events),
                              ("billing_events", d.billing_events))]
    return reduce(DataFrame.unionByName, parts)


def _violations(name: str, df: DataFrame, rules: dict[str, F.Column]) -> DataFrame:
    counted = df.agg(*[F.count_if(cond).alias(rule) for rule, cond in rules.items()])
    stack = ", ".join(f"'{r}', `{r}`" for r in rules)
    return counted.selectExpr(f"'{name}' AS table_name",
                              f"stack({len(rules)}, {stack}) AS (rule, violations)")


def domain_violations(d: Domain) -> DataFrame:
    """(table_name, rule, violations): enum, non-negative and not-null rules."""
    c = F.col
    users = _violations("users", d.users, {
        "user_id_null": c("user_id").isNull(),
        "plan_type_domain": ~F.coalesce(c("plan_type").isin(*S.PLAN_TYPES), F.lit(False)),
        "signup_date_null": c("signup_date").isNull(),
    })
    events = _violations("user_events", d.user_events, {
        "user_id_null": c("user_id").isNull(),
        "event_type_domain": ~F.coalesce(c("event_type").isin(*S.EVENT_TYPES), F.lit(False)),
        "event_time_null": c("event_time").isNull(),
    })
    billing = _violations("billing_events", d.billing_events, {
        "user_id_null": c("user_id").isNull(),
        "status_domain": ~F.coalesce(c("status").isin(*S.BILLING_STATUSES), F.lit(False)),
        "amount_negative": c("amount").isNull() | (c("amount") < 0),
        "event_time_null": c("event_time").isNull(),
    })
    return users.unionByName(events).unionByName(billing)


def orphan_events(d: Domain) -> DataFrame:
    """(table_name, orphan_rows, orphan_users): fact rows whose user does not exist."""
    ids = d.users.select("user_id")
    parts = []
    for name, df in (("user_events", d.user_events), ("billing_events", d.billing_events)):
        orphans = df.select("user_id").join(ids, "user_id", "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).alias("orphan_rows"),
                                 F.count_distinct("user_id").alias("orphan_users"))
                     .select(F.lit(name).alias("table_name"), "orphan_rows", "orphan_users"))
    return parts[0].unionByName(parts[1])
