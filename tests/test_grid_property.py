"""Property: the bucketed feature/label grid equals a brute-force evaluation of
the catalogue definitions on random frames, for random grids (start, n, step)."""
import datetime as dt
import math
import random

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from churnlake.operators import features as FE
from frames import domain

BASE = dt.datetime(2024, 1, 1)


def _brute(users, events, billing, dates):
    out = {}
    for d in dates:
        for uid, plan, signup, _ in users:
            ev = [e for e in events if e[0] == uid]
            w30 = [e for e in ev if d - dt.timedelta(days=30) <= e[2] < d]
            w7 = [e for e in ev if d - dt.timedelta(days=7) <= e[2] < d]
            logins = [e[2] for e in ev if e[1] == "login" and e[2] < d]
            bl = [b for b in billing if b[0] == uid]
            b30 = [b for b in bl if d - dt.timedelta(days=30) <= b[3] < d]
            b90 = [b for b in bl if d - dt.timedelta(days=90) <= b[3] < d]
            nxt = any(d <= e[2] < d + dt.timedelta(days=30) for e in ev) or any(
                b[2] == "successful" and d <= b[3] < d + dt.timedelta(days=30) for b in bl)
            # complete seconds, then whole days rounded half up
            last = math.floor(((d - max(logins)).total_seconds() // 1) / 86400.0 + 0.5) if logins else 9999
            out[(uid, d)] = {
                "avg_sessions_7d": len({e[3] for e in w7 if e[3] is not None}) / 7.0,
                "sessions_30d": len({e[3] for e in w30 if e[3] is not None}),
                "days_since_last_login": int(last),
                "events_30d": len(w30),
                "failed_payments_30d": sum(1 for b in b30 if b[2] == "failed"),
                "total_spend_90d": sum(b[1] for b in b90 if b[2] == "successful"),
                "refunds_30d": sum(1 for b in b30 if b[2] == "refunded"),
                "churned_30d": 0 if nxt else 1,
            }
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), n=st.integers(1, 40), step=st.sampled_from([1, 2, 3, 7, 10, 40]))
def test_grid_matches_brute_force(spark, seed, n, step):
    rnd = random.Random(seed)
    users = [(u, rnd.choice(["free", "basic", "pro"]), BASE - dt.timedelta(days=rnd.randint(0, 400)), "US")
             for u in range(4)]
    t = lambda: BASE + dt.timedelta(minutes=rnd.randint(-150 * 1440, 150 * 1440))
    events = [(rnd.randrange(5), rnd.choice(["login", "page_view", "search"]), t(),
               rnd.choice([None, "a", "b", "c", "d"])) for _ in range(60)]
    billing = [(rnd.randrange(5), float(rnd.randint(1, 50)), rnd.choice(["successful", "failed", "refunded"]), t())
               for _ in range(25)]
    start = BASE + dt.timedelta(days=rnd.randint(-60, 60))
    dates = [start + dt.timedelta(days=step * k) for k in range(n)]
    got = FE.feature_grid(domain(spark, users, events, billing), FE.make_grid(start.date().isoformat(), n, step),
                          with_label=True).toPandas()
    want = _brute(users, events, billing, dates)
    assert len(got) == len(want)
    for r in got.itertuples(index=False):
        exp = want[(r.user_id, pd.Timestamp(r.feature_date).to_pydatetime())]
        for c, v in exp.items():
            g = getattr(r, c)
            ok = abs(g - v) < 1e-9 if isinstance(v, float) else g == v
            assert ok, (c, r.user_id, r.feature_date, g, v)
