"""DuckDB SQL text of the same jobs, used as the correctness oracle.

The oracle is written the plain way (range joins against a calendar, correlated
conditions as FILTER clauses) so that it checks the bucketed Spark plans
independently. Table views ``customer nation events orders lineitem`` are
registered by the caller; the churn tables are CTEs defined here.
"""

from __future__ import annotations

import datetime as _dt

_PLAN = ("CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'pro' "
         "WHEN c.c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN 'basic' ELSE 'free' END")


def _users_cte(origin: str) -> str:
    return f"""users AS (
  SELECT CAST(c.c_custkey AS BIGINT) AS user_id, {_PLAN} AS plan_type,
         TIMESTAMP '{origin}' - to_days(CAST(c.c_custkey % 365 AS INTEGER)) AS signup_date,
         n.n_name AS country
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


MAPPING_A = _users_cte("2024-01-15") + """,
user_events AS (
  SELECT CAST(user_id AS BIGINT) AS user_id,
         CASE event_type WHEN 'signup' THEN 'login' WHEN 'view' THEN 'page_view'
                         WHEN 'click' THEN 'search' ELSE event_type END AS event_type,
         ts AS event_time,
         concat(CAST(user_id AS VARCHAR), '-', CAST(CAST(ts AS DATE) AS VARCHAR)) AS session_id
  FROM events WHERE event_type NOT IN ('purchase', 'error')),
billing_events AS (
  SELECT CAST(user_id AS BIGINT) AS user_id, value AS amount,
         CASE WHEN event_type = 'error' THEN 'failed'
              WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 5 THEN 'refunded'
              ELSE 'successful' END AS status,
         ts AS event_time
  FROM events WHERE event_type IN ('purchase', 'error') AND value >= 0)"""

MAPPING_B = _users_cte("1995-01-01") + """,
user_events AS (
  SELECT CAST(o.o_custkey AS BIGINT) AS user_id,
         CASE WHEN l.l_linenumber = 1 THEN 'login' ELSE 'page_view' END AS event_type,
         l.l_shipdate AS event_time, CAST(l.l_orderkey AS VARCHAR) AS session_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
billing_events AS (
  SELECT CAST(o_custkey AS BIGINT) AS user_id, o_totalprice AS amount,
         CASE o_orderstatus WHEN 'F' THEN 'successful' WHEN 'O' THEN 'failed'
                            WHEN 'P' THEN 'refunded' END AS status,
         o_orderdate AS event_time
  FROM orders WHERE o_totalprice >= 0)"""

MAPPING_SQL = {"A": MAPPING_A, "B": MAPPING_B}

FEATURE_SQL = {
    "avg_sessions_7d": "(coalesce(a.s7, 0) / 7.0)",
    "sessions_30d": "CAST(coalesce(a.s30, 0) AS BIGINT)",
    "days_since_last_login": ("coalesce(CAST(round(date_sub('second', l.last_login, g.feature_date) / 86400.0)"
                              " AS INTEGER), 9999)"),
    "events_30d": "CAST(coalesce(a.e30, 0) AS BIGINT)",
    "failed_payments_30d": "CAST(coalesce(b.f30, 0) AS BIGINT)",
    "total_spend_90d": "CAST(coalesce(b.spend, 0.0) AS DOUBLE)",
    "refunds_30d": "CAST(coalesce(b.r30, 0) AS BIGINT)",
    "is_pro_plan": "CAST(CASE WHEN u.plan_type = 'pro' THEN 1 ELSE 0 END AS INTEGER)",
    "is_paid_plan": "CAST(CASE WHEN u.plan_type IN ('basic', 'pro') THEN 1 ELSE 0 END AS INTEGER)",
    "days_since_signup": "CAST(round(date_sub('second', u.signup_date, g.feature_date) / 86400.0) AS INTEGER)",
}
FEATURE_ORDER = tuple(FEATURE_SQL)


def dates_cte(start, n: int = 1, step_days: int = 7) -> str:
    s = str(start)[:10]
    return (f"dates AS (SELECT TIMESTAMP '{s}' + to_days(CAST(k * {int(step_days)} AS INTEGER)) AS feature_date "
            f"FROM range(0, {int(n)}) t(k))")


def grid_sql(mapping: str, start, n: int = 1, step_days: int = 7, features=FEATURE_ORDER,
             with_label: bool = False, existing_only: bool = False, user_filter: str | None = None,
             extra_ctes: str = "", prefix: str = "", with_mapping: bool = True,
             label_days: int = 30) -> str:
    """CTE list ending in ``{prefix}snap``: features (+ label) per user and date.

    ``prefix`` renames the grid CTEs so that two grids can share one query;
    ``with_mapping=False`` leaves out the leading ``WITH <mapping>,``."""
    cols = ",\n         ".join(f"{FEATURE_SQL[f]} AS {f}" for f in features)
    if cols:
        cols = ",\n         " + cols
    label = ""
    label_join = ""
    if with_label:
        label = ",\n         CAST(CASE WHEN lab.user_id IS NULL THEN 1 ELSE 0 END AS INTEGER) AS churned_30d"
        label_join = "LEFT JOIN lab ON lab.user_id = u.user_id AND lab.feature_date = g.feature_date"
    where = []
    if existing_only:
        where.append("u.signup_date < g.feature_date")
    if user_filter:
        where.append(user_filter)
    where_sql = ("WHERE " + " AND ".join(where)) if where else ""
    mapping_sql = MAPPING_SQL.get(mapping, mapping)
    head = f"WITH {mapping_sql},\n" if with_mapping else ""
    text = f"""{head}{dates_cte(start, n, step_days)},
a AS (
  SELECT g.feature_date, e.user_id,
         count(DISTINCT e.session_id) FILTER (WHERE e.event_time >= g.feature_date - INTERVAL 7 DAY) AS s7,
         count(DISTINCT e.session_id) AS s30, count(*) AS e30
  FROM dates g JOIN user_events e
    ON e.event_time >= g.feature_date - INTERVAL 30 DAY AND e.event_time < g.feature_date
  GROUP BY g.feature_date, e.user_id),
l AS (
  SELECT g.feature_date, e.user_id, max(e.event_time) AS last_login
  FROM dates g JOIN user_events e ON e.event_type = 'login' AND e.event_time < g.feature_date
  GROUP BY g.feature_date, e.user_id),
b AS (
  SELECT g.feature_date, e.user_id,
         count(*) FILTER (WHERE e.status = 'failed' AND e.event_time >= g.feature_date - INTERVAL 30 DAY) AS f30,
         sum(e.amount) FILTER (WHERE e.status = 'successful') AS spend,
         count(*) FILTER (WHERE e.status = 'refunded' AND e.event_time >= g.feature_date - INTERVAL 30 DAY) AS r30
  FROM dates g JOIN billing_events e
    ON e.event_time >= g.feature_date - INTERVAL 90 DAY AND e.event_time < g.feature_date
  GROUP BY g.feature_date, e.user_id),
lab AS (
  SELECT DISTINCT g.feature_date, x.user_id FROM dates g JOIN (
      SELECT user_id, event_time FROM user_events
      UNION ALL SELECT user_id, event_time FROM billing_events WHERE status = 'successful') x
    ON x.event_time >= g.feature_date AND x.event_time < g.feature_date + INTERVAL {int(label_days)} DAY){extra_ctes},
snap AS (
  SELECT u.user_id, g.feature_date{cols}{label}
  FROM users u CROSS JOIN dates g
  LEFT JOIN a ON a.user_id = u.user_id AND a.feature_date = g.feature_date
  LEFT JOIN l ON l.user_id = u.user_id AND l.feature_date = g.feature_date
  LEFT JOIN b ON b.user_id = u.user_id AND b.feature_date = g.feature_date
  {label_join}
  {where_sql})"""
    if prefix:
        for name in ("dates", "a", "l", "b", "lab", "snap"):
            text = text.replace(f"\n{name} AS (", f"\n{prefix}{name} AS (")
            if text.startswith(f"{name} AS ("):
                text = f"{prefix}{text}"
        text = (text.replace("FROM dates g", f"FROM {prefix}dates g").replace("CROSS JOIN dates g", f"CROSS JOIN {prefix}dates g")
                .replace("LEFT JOIN a ON", f"LEFT JOIN {prefix}a a ON").replace("LEFT JOIN l ON", f"LEFT JOIN {prefix}l l ON")
                .replace("LEFT JOIN b ON", f"LEFT JOIN {prefix}b b ON")
                .replace("LEFT JOIN lab ON", f"LEFT JOIN {prefix}lab lab ON"))
    return text


def snapshot_sql(mapping: str, date, **kw) -> str:
    return grid_sql(mapping, date, 1, 1, **kw) + "\nSELECT * FROM snap"


def iso(d) -> str:
    if isinstance(d, (_dt.date, _dt.datetime)):
        return d.isoformat()[:10]
    return str(d)[:10]


PREDICTIONS_CTE = """predictions AS (
  SELECT CAST(event_id AS BIGINT) AS prediction_id, CAST(user_id AS BIGINT) AS user_id,
         least(value / 500.0, 1.0) AS churn_probability,
         CAST(CASE WHEN least(value / 500.0, 1.0) >= 0.1 THEN 1 ELSE 0 END AS INTEGER) AS predicted_label,
         ts AS prediction_time,
         CASE WHEN event_id % 2 = 0 THEN '1.0' ELSE '2.0' END AS model_version,
         (event_id % 50) / 10.0 AS latency_ms, event_type <> 'error' AS from_cache, false AS is_monitored
  FROM events)"""


def long_sql(frame: str, features) -> str:
    """Unpivot ``frame`` to (feature_name, value), dropping nulls / NaN."""
    return "\n  UNION ALL ".join(
        f"SELECT '{c}' AS feature_name, CAST({c} AS DOUBLE) AS value FROM {frame} "
        f"WHERE {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))" for c in features)


def newton_sql(rows: str, label: str, columns, steps: int = 12, prefix: str = "nw") -> str:
    """CTEs that fit a logistic regression in plain SQL: Newton steps on the mean loss
    of ``rows`` (standardised ``columns`` and ``label``) with an L2 penalty of 1/n on
    all but the intercept. The last one, ``{prefix}_w``, is one row of w0, w1 ...

    A step sums gradient and Hessian over all rows and solves by elimination, one CTE
    for each pivot."""
    m = len(columns) + 1
    z = ["1.0", *columns]
    score = " + ".join(f"w.w{i} * {x}" for i, x in enumerate(z))
    out = [f"{prefix}_0 AS MATERIALIZED (SELECT " + ", ".join(f"0.0::DOUBLE AS w{i}" for i in range(m)) + ")",
           f"{prefix}_n AS MATERIALIZED (SELECT count(*)::DOUBLE AS n FROM {rows})"]
    for t in range(steps):
        e = f"{prefix}_{t}"
        w = ", ".join(f"w.w{i}" for i in range(m))
        out.append(f"{e}_p AS MATERIALIZED (SELECT r.*, 1.0 / (1.0 + exp(-({score}))) AS p_ FROM {rows} r, {e} w)")
        sums = [f"avg((p_ - {label}) * {x}) AS g{i}" for i, x in enumerate(z)]
        sums += [f"avg(p_ * (1 - p_) * {z[i]} * {z[j]}) AS h{i}_{j}" for i in range(m) for j in range(i, m)]
        out.append(f"{e}_s AS MATERIALIZED (SELECT {', '.join(sums)} FROM {e}_p)")
        ridge = lambda i, v: f" + {v} / n" if i else ""
        cols = [f"g{i}{ridge(i, f'w{i}')} AS g{i}" for i in range(m)]
        cols += [f"h{i}_{j}{ridge(i, '1.0') if i == j else ''} AS h{i}_{j}" for i in range(m) for j in range(i, m)]
        out.append(f"{e}_e0 AS MATERIALIZED (SELECT {', '.join(cols)}, {w} FROM {e}_s, {prefix}_n, {e} w)")
        for k in range(m - 1):
            new = {f"g{i}": f"g{i} - h{k}_{i} * g{k} / h{k}_{k}" for i in range(k + 1, m)}
            new |= {f"h{i}_{j}": f"h{i}_{j} - h{k}_{i} * h{k}_{j} / h{k}_{k}" for i in range(k + 1, m) for j in range(i, m)}
            repl = ", ".join(f"{v} AS {c}" for c, v in new.items())
            out.append(f"{e}_e{k + 1} AS MATERIALIZED (SELECT * REPLACE ({repl}) FROM {e}_e{k})")
        at = f"{e}_e{m - 1}"
        for k in range(m - 1, -1, -1):
            back = "".join(f" - h{k}_{j} * x{j}" for j in range(k + 1, m))
            out.append(f"{e}_x{k} AS MATERIALIZED (SELECT *, (g{k}{back}) / h{k}_{k} AS x{k} FROM {at})")
            at = f"{e}_x{k}"
        name = f"{prefix}_w" if t == steps - 1 else f"{prefix}_{t + 1}"
        out.append(f"{name} AS MATERIALIZED (SELECT " + ", ".join(f"w{i} - x{i} AS w{i}" for i in range(m)) + f" FROM {at})")
    return ",\n".join(out)
