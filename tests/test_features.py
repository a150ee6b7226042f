"""Point-in-time features and labels on hand-made frames (window edges,
fan-out, defaults, rounding, leakage, label edges)."""
import datetime as dt
import re

from pyspark.sql import functions as F

from churnlake.operators import features as FE
from frames import T, domain

D = "2024-02-01"
U1 = (1, "pro", T("2023-06-01 00:00:00"), "US")
U2 = (2, "free", T("2023-06-01 00:00:00"), "CA")
U3 = (3, "basic", T("2024-02-10 00:00:00"), "DE")   # signs up after D


def snap(spark, events=(), billing=(), users=(U1, U2, U3), **kw):
    d = domain(spark, users, events, billing)
    rows = FE.feature_snapshot(d, D, **kw).collect()
    return {r["user_id"]: r.asDict() for r in rows}


def test_half_open_windows(spark):
    ev = [(1, "page_view", T("2024-02-01 00:00:00"), "s1"),   # exactly at the date: excluded
          (1, "page_view", T("2024-01-02 00:00:00"), "s2"),   # exactly d - 30d: included
          (1, "page_view", T("2024-01-01 23:59:59"), "s3")]   # before the window
    r = snap(spark, ev)[1]
    assert r["events_30d"] == 1
    assert r["sessions_30d"] == 1
    assert r["avg_sessions_7d"] == 0.0


def test_seven_day_sessions_and_null_session(spark):
    ev = [(1, "page_view", T("2024-01-25 10:00:00"), "a"), (1, "search", T("2024-01-25 10:05:00"), "a"),
          (1, "page_view", T("2024-01-31 23:00:00"), "b"), (1, "page_view", T("2024-01-20 00:00:00"), "c"),
          (1, "page_view", T("2024-01-30 00:00:00"), None)]
    r = snap(spark, ev)[1]
    assert r["events_30d"] == 5
    assert r["sessions_30d"] == 3          # null session ignored
    assert abs(r["avg_sessions_7d"] - 2 / 7.0) < 1e-12   # a and b inside [d-7d, d)


def test_fan_out_guard(spark):
    ev = [(1, "page_view", T(f"2024-01-2{i} 00:00:00"), f"s{i}") for i in range(3)]
    bill = [(1, 10.0, "successful", T("2024-01-10 00:00:00")), (1, 5.5, "successful", T("2024-01-11 00:00:00"))]
    r = snap(spark, ev, bill)[1]
    assert r["events_30d"] == 3
    assert r["total_spend_90d"] == 15.5


def test_user_without_facts_gets_defaults_and_label(spark):
    r = snap(spark, with_label=True)[2]
    assert r["events_30d"] == 0 and r["sessions_30d"] == 0 and r["total_spend_90d"] == 0.0
    assert r["days_since_last_login"] == 9999
    assert r["churned_30d"] == 1


def test_only_non_login_events_mean_never_logged_in(spark):
    r = snap(spark, [(1, "search", T("2024-01-30 00:00:00"), "x")])[1]
    assert r["days_since_last_login"] == 9999


def test_last_login_rounding_and_unbounded_history(spark):
    ev = [(1, "login", T("2024-01-29 12:00:00"), "x"),      # 2.5 days before D -> 3
          (2, "login", T("2022-01-01 00:00:00"), "y")]      # far outside every window
    r = snap(spark, ev)
    assert r[1]["days_since_last_login"] == 3
    assert r[2]["days_since_last_login"] == (dt.date(2024, 2, 1) - dt.date(2022, 1, 1)).days


def test_signup_after_date_existing_only(spark):
    off = snap(spark)
    assert off[3]["days_since_signup"] == -9
    on = snap(spark, existing_only=True)
    assert 3 not in on and 1 in on


def test_billing_windows(spark):
    bill = [(1, 9.99, "failed", T("2024-01-15 00:00:00")), (1, 9.99, "failed", T("2023-12-20 00:00:00")),
            (1, 29.99, "successful", T("2023-11-03 00:00:00")),  # exactly d - 90d: included
            (1, 29.99, "successful", T("2023-11-02 23:59:59")),  # outside
            (1, 29.99, "refunded", T("2024-01-31 00:00:00"))]
    r = snap(spark, billing=bill)[1]
    assert r["failed_payments_30d"] == 1
    assert r["total_spend_90d"] == 29.99
    assert r["refunds_30d"] == 1


def test_label_edges(spark):
    bill = [(1, 9.99, "failed", T("2024-02-05 00:00:00"))]      # failed payment only: still churned
    ev = [(2, "page_view", T("2024-02-01 00:00:00"), "x"),     # activity exactly at the date: retained
          (3, "page_view", T("2024-03-02 00:00:00"), "y")]     # exactly d + 30d: not counted
    r = snap(spark, ev, bill, with_label=True)
    assert r[1]["churned_30d"] == 1
    assert r[2]["churned_30d"] == 0
    assert r[3]["churned_30d"] == 1


def test_future_events_do_not_change_snapshot(spark):
    base = [(1, "login", T("2024-01-20 00:00:00"), "a"), (2, "page_view", T("2024-01-28 00:00:00"), "b")]
    future = base + [(1, "login", T("2024-02-01 00:00:00"), "f"), (2, "page_view", T("2024-03-01 00:00:00"), "g")]
    assert snap(spark, base) == snap(spark, future)


def test_snapshot_equals_slice_of_grid(spark):
    ev = [(u, t, T(f"2024-01-{d:02d} {h:02d}:00:00"), f"s{u}{d}")
          for u in (1, 2) for d in range(1, 29, 3) for h, t in ((1, "login"), (9, "page_view"))]
    bill = [(1, 10.0, "successful", T("2024-01-05 00:00:00")), (2, 3.0, "failed", T("2024-01-17 00:00:00"))]
    d = domain(spark, (U1, U2, U3), ev, bill)
    grid = FE.feature_grid(d, FE.make_grid("2024-01-04", 5, 6), with_label=True)
    for k in range(5):
        day = dt.date(2024, 1, 4) + dt.timedelta(days=6 * k)
        one = FE.feature_snapshot(d, day.isoformat(), with_label=True)
        part = grid.filter(F.col("feature_date") == F.lit(day.isoformat()).cast("timestamp_ntz"))
        assert one.exceptAll(part).count() == 0 and part.exceptAll(one).count() == 0


def test_custom_feature_spec(spark):
    bill = [(1, 10.0, "successful", T("2024-01-10 00:00:00")), (1, 30.0, "successful", T("2023-12-01 00:00:00")),
            (1, 99.0, "failed", T("2024-01-20 00:00:00"))]
    spec = (FE.FeatureSpec("avg_paid_90d", "billing", "avg", "amount", lambda: F.col("status") == "successful", 90, None),
            FE.FeatureSpec("rows_30d", "billing", "count", None, None, 30, 0, "long"))
    r = snap(spark, billing=bill, features=(), custom=spec)
    assert r[1]["avg_paid_90d"] == 20.0 and r[1]["rows_30d"] == 2
    assert r[2]["avg_paid_90d"] is None and r[2]["rows_30d"] == 0


def test_dates_are_spread_after_everything_that_holds_rows(spark):
    """Users times dates is no input of a sum, sort or join: one task's share of the
    users, which may be a whole file of them, would be held for every date."""
    d = domain(spark, [(1, "pro", T("2024-01-01"), "X")], [(1, "login", T("2024-01-05 10:00:00"), "s")])
    plan = FE.feature_grid(d, FE.make_grid("2024-01-01", 31, 1))._jdf.queryExecution().optimizedPlan().toString()
    at = [i for i, line in enumerate(plan.splitlines()) if "explode(sequence(" in line]
    held = [i for i, line in enumerate(plan.splitlines()) if re.search(r"Aggregate|Window|Join", line)]
    assert len(at) == 1 and held and at[0] < min(held)


def test_a_users_values_run_on_between_changes_and_before_the_first(spark):
    users = [(1, "pro", T("2024-01-01"), "X"), (1, "free", T("2024-01-01"), "X"), (2, "free", T("2024-01-01"), "X")]
    events = [(1, "login", T("2024-01-05 10:00:00"), "s"), (3, "login", T("2024-01-02"), "s")]
    got = FE.feature_grid(domain(spark, users, events), FE.make_grid("2024-01-03", 40, 1)).collect()
    assert sorted(r.user_id for r in got) == [1] * 80 + [2] * 40
    for r in got:
        day = (r.feature_date - T("2024-01-03")).days
        assert r.events_30d == int(r.user_id == 1 and 3 <= day < 33), r
        assert (r.days_since_last_login == 9999) == (r.user_id == 2 or day < 3), r
