"""Registered source / load / store queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.operators import features as FE
from churnlake.operators import loads as L
from churnlake.plans import oracle_sql as O
from churnlake.plans.q_features import STORE_N_A, STORE_START_A, STORE_STEP_A
from churnlake.plans.registry import register
from churnlake.session import scratch_path
from churnlake.sources import store as ST
from churnlake.sources.tables import mapping_a, mapping_b, src_billing_events, src_user_events, src_users

A = "WITH " + O.MAPPING_A + "\n"


@register("src_users", A + "SELECT user_id, plan_type, signup_date, country FROM users")
def q_src_users(spark, sf_dir):
    return src_users(mapping_a(spark, sf_dir))


@register("src_user_events", A + "SELECT user_id, event_type, event_time, session_id FROM user_events")
def q_src_user_events(spark, sf_dir):
    return src_user_events(mapping_a(spark, sf_dir))


@register("src_billing_events", A + "SELECT user_id, amount, status, event_time FROM billing_events")
def q_src_billing_events(spark, sf_dir):
    return src_billing_events(mapping_a(spark, sf_dir))


@register("all_users", A + "SELECT user_id FROM users ORDER BY user_id")
def q_all_users(spark, sf_dir):
    return mapping_a(spark, sf_dir).users.select("user_id").orderBy("user_id")


_INSERT_IGNORE_SQL = f"""WITH {O.MAPPING_A.replace('users AS', 'ua AS', 1)},
{O._users_cte('1995-01-01').replace('users AS', 'ub AS', 1)},
target AS (SELECT * FROM ua WHERE signup_date < TIMESTAMP '2024-01-01'),
incoming AS (SELECT * FROM ua UNION ALL SELECT * FROM ub),
fresh AS (SELECT user_id, arg_min(plan_type, signup_date) AS plan_type, min(signup_date) AS signup_date,
                 arg_min(country, signup_date) AS country
          FROM incoming GROUP BY user_id)
SELECT user_id, plan_type, signup_date, country FROM target
UNION ALL
SELECT user_id, plan_type, signup_date, country FROM fresh
WHERE user_id NOT IN (SELECT user_id FROM target)"""


@register("load_users_ignore", _INSERT_IGNORE_SQL)
def q_load_users_ignore(spark, sf_dir):
    """Re-load of every user from both mappings into the users who signed up
    before 2024: existing keys are kept, in-batch duplicates keep the earliest."""
    a, b = mapping_a(spark, sf_dir).users, mapping_b(spark, sf_dir).users
    target = a.filter(F.col("signup_date") < F.lit("2024-01-01").cast("timestamp_ntz"))
    return L.insert_ignore(target, a.unionByName(b), "user_id", ["signup_date"])


@register("table_row_counts", A + """
SELECT 'users' AS table_name, count(*) AS row_count FROM users
UNION ALL SELECT 'user_events', count(*) FROM user_events
UNION ALL SELECT 'billing_events', count(*) FROM billing_events""")
def q_table_row_counts(spark, sf_dir):
    return L.table_row_counts(mapping_a(spark, sf_dir))


_ENUMS = ("('free','basic','pro')",
          "('login','logout','page_view','search','download','upgrade','downgrade')",
          "('successful','failed','refunded')")


def _domain_sql(mapping: str) -> str:
    raw = O.MAPPING_SQL[mapping].replace(" WHERE o_totalprice >= 0", "").replace(" AND value >= 0", "")
    return f"""WITH {raw},
uv AS (SELECT count(*) FILTER (WHERE user_id IS NULL) AS a,
              count(*) FILTER (WHERE NOT coalesce(plan_type IN {_ENUMS[0]}, false)) AS b,
              count(*) FILTER (WHERE signup_date IS NULL) AS c FROM users),
ev AS (SELECT count(*) FILTER (WHERE user_id IS NULL) AS a,
              count(*) FILTER (WHERE NOT coalesce(event_type IN {_ENUMS[1]}, false)) AS b,
              count(*) FILTER (WHERE event_time IS NULL) AS c FROM user_events),
bv AS (SELECT count(*) FILTER (WHERE user_id IS NULL) AS a,
              count(*) FILTER (WHERE NOT coalesce(status IN {_ENUMS[2]}, false)) AS b,
              count(*) FILTER (WHERE amount IS NULL OR amount < 0) AS c,
              count(*) FILTER (WHERE event_time IS NULL) AS d FROM billing_events)
SELECT 'users' AS table_name, 'user_id_null' AS rule, a AS violations FROM uv
UNION ALL SELECT 'users', 'plan_type_domain', b FROM uv
UNION ALL SELECT 'users', 'signup_date_null', c FROM uv
UNION ALL SELECT 'user_events', 'user_id_null', a FROM ev
UNION ALL SELECT 'user_events', 'event_type_domain', b FROM ev
UNION ALL SELECT 'user_events', 'event_time_null', c FROM ev
UNION ALL SELECT 'billing_events', 'user_id_null', a FROM bv
UNION ALL SELECT 'billing_events', 'status_domain', b FROM bv
UNION ALL SELECT 'billing_events', 'amount_negative', c FROM bv
UNION ALL SELECT 'billing_events', 'event_time_null', d FROM bv"""


@register("domain_violations", _domain_sql("B"))
def q_domain_violations(spark, sf_dir):
    return L.domain_violations(mapping_b(spark, sf_dir, checked=False))


@register("orphan_events", f"""WITH {O.MAPPING_B}
SELECT 'user_events' AS table_name, count(*) AS orphan_rows, count(DISTINCT user_id) AS orphan_users
FROM user_events e WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.user_id = e.user_id)
UNION ALL
SELECT 'billing_events', count(*), count(DISTINCT user_id)
FROM billing_events e WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.user_id = e.user_id)""")
def q_orphan_events(spark, sf_dir):
    return L.orphan_events(mapping_b(spark, sf_dir))


STORE_SQL = O.grid_sql("A", STORE_START_A, STORE_N_A, STORE_STEP_A)


def offline_store(spark, sf_dir):
    """Compute the weekly January snapshots of mapping A, write them to a new
    date-partitioned store under the checkpoint root and read it back."""
    grid = FE.feature_grid(mapping_a(spark, sf_dir), FE.make_grid(STORE_START_A, STORE_N_A, STORE_STEP_A))
    path = scratch_path(spark, "offline-store")
    ST.write_snapshots(grid, path)
    return ST.read_store(spark, path, grid.schema)


@register("offline_store_roundtrip", STORE_SQL + "\nSELECT * FROM snap")
def q_offline_store_roundtrip(spark, sf_dir):
    return offline_store(spark, sf_dir)


@register("snapshot_for_date", STORE_SQL + "\nSELECT * FROM snap WHERE feature_date = TIMESTAMP '2024-01-22'")
def q_snapshot_for_date(spark, sf_dir):
    return ST.snapshot_for_date(offline_store(spark, sf_dir), "2024-01-22")


@register("features_in_range", STORE_SQL + """
SELECT * FROM snap WHERE feature_date >= TIMESTAMP '2024-01-10' AND feature_date < TIMESTAMP '2024-01-29'
ORDER BY feature_date, user_id""")
def q_features_in_range(spark, sf_dir):
    return ST.features_in_range(offline_store(spark, sf_dir), "2024-01-10", "2024-01-29")


@register("store_rewrite_partition", STORE_SQL + "\nSELECT * FROM snap")
def q_store_rewrite_partition(spark, sf_dir):
    """Recomputing one date overwrites just that partition: write the grid,
    then rewrite 2024-01-15 alone; the store must still equal the grid."""
    d = mapping_a(spark, sf_dir)
    grid = FE.feature_grid(d, FE.make_grid(STORE_START_A, STORE_N_A, STORE_STEP_A))
    path = scratch_path(spark, "offline-store-rw")
    ST.write_snapshots(grid, path)
    ST.write_snapshots(FE.feature_snapshot(d, "2024-01-15"), path)
    return ST.read_store(spark, path, grid.schema)


@register("store_day_partitions", STORE_SQL + """
SELECT *, CAST(year(feature_date) AS INTEGER) AS year, CAST(month(feature_date) AS INTEGER) AS month,
       CAST(day(feature_date) AS INTEGER) AS day FROM snap""")
def q_store_day_partitions(spark, sf_dir):
    """History partitioned by year / month / day."""
    grid = ST.with_date_parts(FE.feature_grid(mapping_a(spark, sf_dir),
                                              FE.make_grid(STORE_START_A, STORE_N_A, STORE_STEP_A)))
    path = scratch_path(spark, "offline-history")
    ST.write_snapshots(grid, path, ("year", "month", "day"))
    return ST.read_store(spark, path, grid.schema).select(*grid.columns)


@register("append_load_events", A + "SELECT user_id, event_type, event_time, session_id FROM user_events "
          "UNION ALL SELECT user_id, event_type, event_time, session_id FROM user_events")
def q_append_load_events(spark, sf_dir):
    """Two batch appends of the activity table into one folder."""
    ev = src_user_events(mapping_a(spark, sf_dir))
    path = scratch_path(spark, "append-events")
    L.append_load(ev, path)
    L.append_load(ev, path)
    return spark.read.schema(ev.schema).parquet(path)


@register("append_load_billing", A + "SELECT user_id, amount, status, event_time FROM billing_events")
def q_append_load_billing(spark, sf_dir):
    bill = src_billing_events(mapping_a(spark, sf_dir))
    path = scratch_path(spark, "append-billing")
    L.append_load(bill, path)
    return spark.read.schema(bill.schema).parquet(path)
