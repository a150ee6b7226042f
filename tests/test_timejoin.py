"""As-of and interval joins, carried state and bitmap counts against plain versions."""
import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from churnlake.operators import distinct as D
from churnlake.operators import features as FE
from churnlake.operators import state as ST
from churnlake.operators import timejoin as TJ
from churnlake.session import scratch_path
from churnlake.sources.tables import mapping_a
from frames import domain

SF = "/root/testdata/sf0.001"
BASE = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else BASE + dt.timedelta(minutes=minutes)


def points(rnd, n):
    """A third of the rows belong to one user; null users and times, repeated rows."""
    rows = [(i, rnd.choice([7, 7, 1, 2, 3, 9, None]), at(rnd.choice([None, *range(0, 9000, 7)]))) for i in range(n)]
    return rows + rows[:3]


def vectors(rnd):
    keys = {(u, m) for u in (7, 1, 2, 4) for m in rnd.sample(range(0, 9000, 7), 12)}
    return [(u, at(m), rnd.randint(0, 99)) for u, m in sorted(keys)] + [(None, at(7), 5), (1, None, 5)]


@pytest.mark.parametrize("bucket", ["DAY", "HOUR"])
@pytest.mark.parametrize("seed", [1, 2])
def test_asof_join(spark, seed, bucket):
    rnd = random.Random(seed)
    left, right = points(rnd, 120), vectors(rnd)
    got = TJ.asof_join(spark.createDataFrame(left, "id long, u long, t timestamp_ntz"),
                       spark.createDataFrame(right, "u long, t timestamp_ntz, v int"), ["u"], "t", "t", ["v"], bucket)
    want = []
    for i, u, t in left:
        best = max(((x, v) for k, x, v in right if k == u and x is not None and x <= t), default=(None, None)) \
            if u is not None and t is not None else (None, None)
        want.append((i, u, t, *best))
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in map(str, r))
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


def test_asof_join_on_empty_sides_and_clashing_names(spark):
    left = spark.createDataFrame([(1, 2, at(3))], "id long, u long, t timestamp_ntz")
    right = spark.createDataFrame([(2, at(1), 9)], "u long, t timestamp_ntz, v int")
    assert TJ.asof_join(left, right.limit(0), ["u"], "t", "t", ["v"]).collect()[0]["v"] is None
    assert TJ.asof_join(left.limit(0), right, ["u"], "t", "t", ["v"]).collect() == []
    with pytest.raises(ValueError):
        TJ.asof_join(left.withColumn("v", F.lit(1)), right, ["u"], "t", "t", ["v"])


def test_asof_join_splits_a_key_by_time(spark):
    left = spark.createDataFrame(points(random.Random(3), 50), "id long, u long, t timestamp_ntz")
    right = spark.createDataFrame(vectors(random.Random(3)), "u long, t timestamp_ntz, v int")
    p = TJ.asof_join(left, right, ["u"], "t", "t", ["v"])._jdf.queryExecution().executedPlan().toString()
    window = next(x for x in p.splitlines() if "Window [" in x and "_in#" in x)
    assert re.search(r"\], \[u#\d+L, _b#\d+\], \[", window)
    assert "NestedLoop" not in p and "Cartesian" not in p


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_interval_join(spark, how):
    rnd = random.Random(4)
    left = points(rnd, 100)
    spans = [(u, at(a), at(a + n), u * 1000 + a) for u in (7, 1, 2, 4) for a, n in
             [(rnd.randrange(0, 9000), rnd.choice([0, 1, 30, 60, 500])) for _ in range(15)]] + [(None, at(0), at(90), 1)]
    got = TJ.interval_join(spark.createDataFrame(left, "id long, u long, t timestamp_ntz"),
                           spark.createDataFrame(spans, "u long, a timestamp_ntz, b timestamp_ntz, name long"),
                           ["u"], "t", "a", "b", 3600, how)
    want = []
    for i, u, t in left:
        hits = [n for k, a, b, n in spans if k == u and u is not None and t is not None and a <= t < b]
        if how in ("inner", "left"):
            want += [(i, n) for n in hits] or ([(i, None)] if how == "left" else [])
        elif bool(hits) == (how == "left_semi"):
            want.append((i,))
    cols = ["id", "name"] if how in ("inner", "left") else ["id"]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=key) == sorted(want, key=key)


def test_login_state_chain_equals_full_history(spark):
    rnd = random.Random(5)
    users = [(u, "free", BASE - dt.timedelta(days=9), "US") for u in range(6)]
    events = [(rnd.randrange(7), rnd.choice(["login", "search"]), at(rnd.randrange(-60 * 1440, 40 * 1440)), "s")
              for _ in range(200)]
    d = domain(spark, users, events)
    path = scratch_path(spark, "state-test")
    for day in ("2024-01-01", "2024-01-02", "2024-01-20", "2024-01-20", "2024-02-05"):
        state = ST.advance_login_state(spark, d.user_events, path, day)
        got = FE.feature_snapshot(d, day, ("days_since_last_login",))
        carried = FE.feature_grid(d, FE.make_grid(day, 1, 1), ("days_since_last_login",), login_state=(state, day))
        assert sorted(map(tuple, carried.collect())) == sorted(map(tuple, got.collect()))
    with pytest.raises(ValueError):
        FE.feature_grid(d, FE.make_grid("2024-01-03", 1, 1), login_state=(state, "2024-02-05"))


def test_advancing_the_state_reads_new_logins_only(spark):
    d = mapping_a(spark, SF)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    p = ST.advanced(ST.logins_between(d.user_events, None, dt.date(2024, 1, 8)), d.user_events, dt.date(2024, 1, 8),
                    dt.date(2024, 1, 15))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(ts,2024-01-08T00:00)" in p and "LessThan(ts,2024-01-15T00:00)" in p


def test_rollup_of_distinct_ids(spark):
    rnd = random.Random(6)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice(["x", "y"]), rnd.choice([None, -5, 0, 7, 32767, 32768, 10**12]))
            for _ in range(80)]
    got = D.rollup_ids(spark.createDataFrame(rows, "g string, h string, i long"), ["g", "h"], "i", "n")
    want = {}
    for r in rows:
        for n in range(3):
            want.setdefault((n, *(r[:n] + (None,) * (2 - n))), []).append(r[2])
    assert {tuple(r)[:3]: (r["n"], r["n_rows"]) for r in got.collect()} == {
        k: (len(set(v) - {None}), len(v)) for k, v in want.items()}


def test_training_summary_of_nothing_and_without_expand(spark):
    t = E.queries()["training_dataset"](spark, SF)
    p = FE.training_summary(t)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in p
    r = FE.training_summary(t.limit(0)).collect()[0]
    assert (r["n_rows"], r["n_users"], r["n_dates"], r["churn_rate"]) == (0, 0, 0, None)
