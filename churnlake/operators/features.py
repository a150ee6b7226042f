"""Point-in-time features and the forward-looking churn label.

One plan computes any number of snapshot dates ``d_k = start + k * step`` days
(k = 0 .. n-1) in a single pass, by difference arrays:

* a fact counts in a window of every date from a first grid index to a last one.
  It adds +x at the first and -x after the last; a running sum over the user's
  indices gives the value at every date. That is two rows a fact and window,
  however long the window and however fine the grid; there is no calendar x
  events join and no explode of facts over dates;
* distinct sessions: the days of a session cover indices that may overlap. Each
  day adds only those that the session's day before did not cover, so a session
  counts once;
* last login needs unbounded history: a login is a value at the first index it
  reaches, and a running max carries it on. ``login_state`` (the last login of
  each user up to a date) replaces the history before that date;
* the label (no activity and no successful payment in ``[d_k, d_k + 30d)``) is the
  same difference array in the other direction.

The changes of all facts are united with one empty row per user and summed by
(user, k), map-side first, so a user that owns a third of all rows is a few rows
per task; the running sums then see at most n rows per user, which are repeated
up to the next change last of all. Facts are never joined. Dates are truncated to midnight; all times are ``timestamp_ntz``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions.timefn import to_python_date
from churnlake.operators.distinct import distinct_ids, id_bitmaps, merged
from churnlake.sources import schemas as S
from churnlake.sources.tables import Domain

LABEL_WINDOW_DAYS = 30
NEVER_LOGGED_IN = 9999


@dataclass(frozen=True)
class FeatureSpec:
    """Declarative feature: aggregate ``agg`` of ``column`` over rows of
    ``source`` matching ``predicate`` inside ``window_days`` before the date."""

    name: str
    source: str  # "events" | "billing"
    agg: str  # count | count_distinct | sum | avg | max | min
    column: str | None = None
    predicate: Callable[[], Column] | None = None
    window_days: int = 30
    default: float | int | None = 0
    dtype: str = "double"


AGGREGATIONS = ("count", "count_distinct", "sum", "avg", "max", "min")


@dataclass(frozen=True)
class Grid:
    start: _dt.date
    n: int = 1
    step_days: int = 7

    @property
    def last(self) -> _dt.date:
        return self.start + _dt.timedelta(days=self.step_days * (self.n - 1))

    def start_sql(self) -> str:
        return f"TIMESTAMP_NTZ'{self.start.isoformat()} 00:00:00'"

    def date_of_sql(self, k: str) -> str:
        return f"{self.start_sql()} + make_dt_interval({k} * {self.step_days})"

    def day_sql(self, t: str) -> str:
        """Calendar-day index of ``t`` relative to the grid start (can be negative)."""
        return f"datediff(to_date({t}), DATE'{self.start.isoformat()}')"


def make_grid(start, n: int = 1, step_days: int = 7) -> Grid:
    if n < 1 or step_days < 1:
        raise ValueError("grid needs n >= 1 and step_days >= 1")
    return Grid(to_python_date(start), int(n), int(step_days))


def _floor_div(x: str, step: int) -> str:
    return f"CAST(floor(({x}) / {float(step)}D) AS INT)"


def _time_range(grid: Grid, before_first: int, after_last: int) -> str:
    """Scan bounds ``d_0 - before_first <= event_time < d_last + after_last``,
    pushed to the parquet scan."""
    lo = (grid.start - _dt.timedelta(days=before_first)).isoformat()
    hi = (grid.last + _dt.timedelta(days=after_last)).isoformat()
    return f"event_time >= TIMESTAMP_NTZ'{lo} 00:00:00' AND event_time < TIMESTAMP_NTZ'{hi} 00:00:00'"


def _before(grid: Grid) -> str:
    return f"event_time < TIMESTAMP_NTZ'{grid.last.isoformat()} 00:00:00'"


def _back(grid: Grid, day: str, window_days: int) -> tuple[str, str]:
    """First and last grid index k with ``d_k - window <= t < d_k`` (SQL text)."""
    return (f"greatest({_floor_div(day, grid.step_days)} + 1, 0)",
            f"least({_floor_div(f'{day} + {window_days}', grid.step_days)}, {grid.n - 1})")


def _forward(grid: Grid, day: str, window_days: int) -> tuple[str, str]:
    """First and last grid index k with ``d_k <= t < d_k + window`` (SQL text)."""
    return (f"greatest({_floor_div(f'{day} - {window_days}', grid.step_days)} + 1, 0)",
            f"least({_floor_div(day, grid.step_days)}, {grid.n - 1})")


def _uncovered(grid: Grid, lo: str, window_days: int) -> str:
    """``lo``, or the index after those of the day ``last`` (null: none) if that is later."""
    return f"CASE WHEN last IS NULL THEN {lo} ELSE greatest({lo}, {_back(grid, 'last', window_days)[1]} + 1) END"


def _change(grid: Grid, lo: str, hi: str, values: dict[str, str], when: str = "true") -> list[tuple[str, dict[str, str]]]:
    """+x at ``lo`` and -x after ``hi``; nothing where lo > hi. One date has no index after it."""
    on = f"{lo} <= {hi} AND ({when})"
    add = (f"CASE WHEN {on} THEN {lo} END", values)
    if grid.n == 1:
        return [add]
    return [add, (f"CASE WHEN {on} THEN {hi} + 1 END", {c: f"-({x})" for c, x in values.items()})]


def _change_rows(rows: DataFrame, grid: Grid, changes: Sequence[tuple[str, dict[str, str]]],
                 types: dict[str, str]) -> DataFrame:
    """``user_id, k`` and the changes of every measure of ``types`` there; changes
    after the last date are left out. The changes of a row are put into one array
    and combined before the shuffle by the group sum that follows."""
    if len(changes) == 1:
        (k, values), = changes
        return rows.selectExpr("user_id", f"{k} AS k", *[f"CAST({values.get(c, '0')} AS {t}) AS {c}" for c, t in types.items()]
                               ).filter(f"k IS NOT NULL AND k < {grid.n}")
    structs = ", ".join("named_struct('k', " + k + "".join(
        f", '{c}', CAST({values.get(c, '0')} AS {t})" for c, t in types.items()) + ")" for k, values in changes)
    return rows.selectExpr("user_id", f"inline(array({structs}))").filter(f"k IS NOT NULL AND k < {grid.n}")


#: Amounts are summed as whole millionths, exactly: a running sum of doubles would
#: leave a rest where payments enter and leave the window.
_MICROS = "CAST(round(amount * 1000000D) AS BIGINT)"


def activity_changes(events: DataFrame, grid: Grid, label_days: int | None = None) -> DataFrame:
    """(user_id, k) changes of events_30d, sessions_30d, sessions_7d [, active_next].

    Events are first counted per (user, session, day), exact since every window is
    a whole number of days; a session's days are then read in order, so that each
    adds the indices that the day before did not cover."""
    types = {"events_30d": "BIGINT", "sessions_30d": "BIGINT", "sessions_7d": "BIGINT"}
    if grid.n == 1:  # one index: a session is one row, no day comes before another
        per = (events.filter(_time_range(grid, 30, label_days or 0))
               .selectExpr("user_id", "session_id", f"{grid.day_sql('event_time')} AS day").groupBy("user_id", "session_id"))
        n = {w: f"count_if(day >= -{w} AND day < 0)" for w in (7, 30)}
        aggs = [f"{n[30]} AS events_30d", *[f"CASE WHEN session_id IS NOT NULL AND {n[w]} > 0 THEN 1L ELSE 0L END"
                                            f" AS sessions_{w}d" for w in (30, 7)]]
        if label_days is not None:
            aggs.append("count_if(day >= 0) AS active_next")
        return per.agg(*[F.expr(a) for a in aggs]).drop("session_id").withColumn("k", F.lit(0))
    daily = (events.filter(_time_range(grid, 30, label_days or 0))
             .selectExpr("user_id", "session_id", f"{grid.day_sql('event_time')} AS day")
             .groupBy("user_id", "session_id", "day").agg(F.expr("count(1) AS c")))
    before = "lag(day) OVER (PARTITION BY user_id, session_id ORDER BY day)"
    daily = daily.selectExpr("*", f"{before} AS last")
    changes = _change(grid, *_back(grid, "day", 30), {"events_30d": "c"})
    for w in (30, 7):
        lo, hi = _back(grid, "day", w)
        changes += _change(grid, _uncovered(grid, lo, w), hi, {f"sessions_{w}d": "1"}, "session_id IS NOT NULL")
    if label_days is not None:
        types["active_next"] = "BIGINT"
        changes += _change(grid, *_forward(grid, "day", label_days), {"active_next": "c"})
    return _change_rows(daily, grid, changes, types)


def billing_changes(billing: DataFrame, grid: Grid, label_days: int | None = None) -> DataFrame:
    """(user_id, k) changes of failed_payments_30d, spend_micros_90d, refunds_30d [, paid_next]."""
    types = {"failed_payments_30d": "BIGINT", "spend_micros_90d": "BIGINT", "refunds_30d": "BIGINT"}
    rows = (billing.filter(_time_range(grid, 90, label_days or 0))
            .selectExpr("user_id", "status", "amount", f"{grid.day_sql('event_time')} AS day"))
    month, quarter = _back(grid, "day", 30), _back(grid, "day", 90)
    changes = (_change(grid, *month, {"failed_payments_30d": "CASE WHEN status = 'failed' THEN 1 ELSE 0 END",
                                "refunds_30d": "CASE WHEN status = 'refunded' THEN 1 ELSE 0 END"},
                       "status IN ('failed', 'refunded')")
               + _change(grid, *quarter, {"spend_micros_90d": f"coalesce({_MICROS}, 0)"}, "status = 'successful'"))
    if label_days is not None:
        types["paid_next"] = "BIGINT"
        changes += _change(grid, *_forward(grid, "day", label_days), {"paid_next": "1"}, "status = 'successful'")
    return _change_rows(rows, grid, changes, types)


def login_values(events: DataFrame, grid: Grid, state: DataFrame | None = None, state_date=None) -> DataFrame:
    """(user_id, k, last_login): the last login that reaches index k first.

    With ``state`` (user_id, last_login: each user's last login before
    ``state_date``) only logins from that date on are read; the state is a value
    at index 0. The state must not be newer than the first snapshot."""
    logins = events.filter(f"event_type = 'login' AND {_before(grid)}")
    if state is not None:
        since = to_python_date(state_date)
        if since > grid.start:
            raise ValueError(f"state of {since} is newer than the first snapshot {grid.start}")
        logins = logins.filter(f"event_time >= TIMESTAMP_NTZ'{since.isoformat()} 00:00:00'")
    first_k = f"greatest({_floor_div(grid.day_sql('event_time'), grid.step_days)} + 1, 0)"
    rows = logins.selectExpr("user_id", f"{first_k} AS k", "event_time AS last_login")
    if state is not None:
        rows = rows.unionByName(state.selectExpr("user_id", "0 AS k", "last_login"))
    return rows


def on_grid(users: DataFrame, grid: Grid, parts: Sequence[DataFrame]) -> DataFrame:
    """Users x grid with the running values of all ``parts`` (``user_id, k`` and
    changes; a column ``last_login`` or ``max_*`` runs as a maximum). A user has one
    row per index where something changes, and one at the first; each is repeated
    for the dates up to the next change only after the users are joined, by their
    id alone, which is how the running rows already lie. What is summed, sorted and
    joined is as long as the changes, not as users times dates."""
    out = users.selectExpr("user_id", "0 AS k")
    values: list[str] = []
    for p in parts:
        values += [c for c in p.columns if c not in ("user_id", "k")]
        out = out.unionByName(p, allowMissingColumns=True)
    if not values:
        return users.selectExpr("*", f"explode(sequence(0, {grid.n - 1})) AS k")
    run = {c: "max" if c == "last_login" or c.startswith("max_") else "sum" for c in values}
    # of one date all rows have the index 0
    by = ["user_id", "k"] if grid.n > 1 else ["user_id"]
    out = out.groupBy(*by).agg(*[F.expr(f"{f}({c}) AS {c}") for c, f in run.items()])
    if grid.n == 1:
        return out.withColumn("k", F.lit(0)).join(users, "user_id")
    w = "OVER (PARTITION BY user_id ORDER BY k{})"
    upto = w.format(" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
    out = out.selectExpr("user_id", "k AS first", f"lead(k, 1, {grid.n}) {w.format('')} AS next",
                         *[f"{f}({c}) {upto} AS {c}" for c, f in run.items()])
    return out.join(users, "user_id").selectExpr("*", "explode(sequence(first, next - 1)) AS k").drop("first", "next")


def custom_changes(source: DataFrame, grid: Grid, specs: Sequence[FeatureSpec]) -> list[DataFrame]:
    """Changes or running values of the declared features of one fact table.

    Sums, counts and averages are difference arrays over the rows. Distinct counts
    are difference arrays over (user, value, day), where a day adds the indices
    that the value's day before did not cover. Extremes cannot be taken back: they
    are exact per (user, day) first and those days, not the rows, go to their
    indices (``at_index``)."""
    rows = (source.filter(_time_range(grid, max(s.window_days for s in specs), 0))
            .withColumn("day", F.expr(grid.day_sql("event_time"))))
    out, types, changes = [], {}, []
    for i, s in enumerate(specs):
        rows = rows.withColumn(f"_on{i}", s.predicate() if s.predicate is not None else F.lit(True))
        rows = rows.withColumn(f"_x{i}", F.when(F.col(f"_on{i}"), F.col(s.column) if s.column else F.lit(1)))
    for i, s in enumerate(specs):
        lo, hi = _back(grid, "day", s.window_days)
        if s.agg in ("count", "sum", "avg"):
            types[f"n_{s.name}"] = "BIGINT"
            values = {f"n_{s.name}": "1"}
            if s.agg != "count":
                types[f"s_{s.name}"] = "DECIMAL(38, 6)"
                values[f"s_{s.name}"] = f"CAST(_x{i} AS DECIMAL(28, 6))"
            changes += _change(grid, lo, hi, values, f"_x{i} IS NOT NULL")
        elif s.agg == "count_distinct":
            days = rows.filter(F.col(f"_x{i}").isNotNull()).select("user_id", F.col(f"_x{i}").alias("v"), "day").distinct()
            days = days.selectExpr("*", "lag(day) OVER (PARTITION BY user_id, v ORDER BY day) AS last")
            fresh = _uncovered(grid, lo, s.window_days)
            out.append(_change_rows(days, grid, _change(grid, fresh, hi, {f"n_{s.name}": "1"}), {f"n_{s.name}": "BIGINT"}))
    if changes:
        out.insert(0, _change_rows(rows, grid, changes, types))
    return out


def at_index(source: DataFrame, grid: Grid, specs: Sequence[FeatureSpec]) -> DataFrame:
    """(user_id, k) -> the declared maxima and minima, from daily extremes."""
    widest = max(s.window_days for s in specs)
    rows = source.filter(_time_range(grid, widest, 0)).withColumn("day", F.expr(grid.day_sql("event_time")))
    pick = {"max": F.max, "min": F.min}
    value = {s.name: F.col(s.column) if s.predicate is None else F.when(s.predicate(), F.col(s.column)) for s in specs}
    daily = rows.groupBy("user_id", "day").agg(*[pick[s.agg](value[s.name]).alias(s.name) for s in specs])
    lo, hi = _back(grid, "day", widest)
    spread = daily.filter(f"{lo} <= {hi}").selectExpr("*", f"explode(sequence({lo}, {hi})) AS k")
    return spread.groupBy("user_id", "k").agg(*[
        pick[s.agg](F.when(F.expr(f"day >= k * {grid.step_days} - {s.window_days}"), F.col(s.name))).alias(s.name)
        for s in specs])


def custom_aggregates(d: Domain, grid: Grid, specs: Sequence[FeatureSpec], users: DataFrame) -> DataFrame:
    """(user_id, k) -> one column per declared spec, for every user and date."""
    parts, extremes = [], []
    for s in specs:
        if s.agg not in AGGREGATIONS:
            raise ValueError(f"unknown aggregation {s.agg!r}")
    for source, frame in (("events", d.user_events), ("billing", d.billing_events)):
        mine = [s for s in specs if s.source == source]
        if sums := [s for s in mine if s.agg not in ("max", "min")]:
            parts += custom_changes(frame, grid, sums)
        if ends := [s for s in mine if s.agg in ("max", "min")]:
            extremes.append(at_index(frame, grid, ends))
    out = on_grid(users.select("user_id").distinct(), grid, parts)
    for e in extremes:
        out = out.join(e, ["user_id", "k"], "left")
    cols = []
    for s in specs:
        v = {"count": f"n_{s.name}", "count_distinct": f"n_{s.name}",
             "sum": f"CASE WHEN n_{s.name} > 0 THEN s_{s.name} END",
             "avg": f"CAST(s_{s.name} AS DOUBLE) / nullif(n_{s.name}, 0)"}.get(s.agg, f"`{s.name}`")
        cols.append(f"{v} AS `{s.name}`")
    return out.selectExpr("user_id", "k", *cols)


def feature_grid(d: Domain, grid: Grid, features: Sequence[str] = S.FEATURE_COLUMNS,
                 with_label: bool = False, existing_only: bool = False,
                 user_ids: DataFrame | None = None,
                 custom: Sequence[FeatureSpec] = (), label_days: int = LABEL_WINDOW_DAYS,
                 login_state: tuple[DataFrame, object] | None = None) -> DataFrame:
    """Features (and optionally the label) for every user at every grid date.

    ``existing_only`` keeps only users who signed up before the date;
    ``user_ids`` (a frame with ``user_id``) restricts the users by a semi join;
    ``login_state`` = (state, date) replaces the logins before that date
    (``login_values``), so only newer ones are read. A user without an id has no
    vector.
    """
    unknown = [f for f in features if f not in S.FEATURE_COLUMNS]
    if unknown:
        raise ValueError(f"unknown features: {unknown}")
    users = d.users.select("user_id", "plan_type", "signup_date")
    need = set(features)
    events, billing = d.user_events, d.billing_events
    if user_ids is not None:
        ids = user_ids.select("user_id")
        users, events, billing = (f.join(ids, "user_id", "left_semi") for f in (users, events, billing))
    parts = []
    lab = label_days if with_label else None
    if with_label or need & {"avg_sessions_7d", "sessions_30d", "events_30d"}:
        parts.append(activity_changes(events, grid, lab))
    if "days_since_last_login" in need:
        parts.append(login_values(events, grid, *(login_state or ())))
    if with_label or need & {"failed_payments_30d", "total_spend_90d", "refunds_30d"}:
        parts.append(billing_changes(billing, grid, lab))
    joined = on_grid(users, grid, parts).selectExpr("*", f"{grid.date_of_sql('k')} AS feature_date")
    if existing_only:
        joined = joined.filter("signup_date < feature_date")
    if custom:
        joined = joined.join(custom_aggregates(Domain(users, events, billing), grid, custom, users),
                             ["user_id", "k"], "left")

    cols = ["user_id", "feature_date"] + [f"{FEATURE_EXPR[f]} AS {f}" for f in S.FEATURE_COLUMNS if f in need]
    for s in custom:
        v = f"coalesce(`{s.name}`, {s.default!r})" if s.default is not None else f"`{s.name}`"
        cols.append(f"CAST({v} AS {s.dtype}) AS `{s.name}`")
    if with_label:
        cols.append("CAST(CASE WHEN coalesce(active_next, 0) > 0 OR coalesce(paid_next, 0) > 0 THEN 0 ELSE 1 END AS INT)"
                    " AS churned_30d")
    return joined.selectExpr(*cols)


# Output expressions of the ten catalogue features over the joined aggregates.
FEATURE_EXPR = {
    "avg_sessions_7d": "coalesce(sessions_7d, 0) / 7.0D",
    "sessions_30d": "CAST(coalesce(sessions_30d, 0) AS BIGINT)",
    "days_since_last_login": (f"coalesce(CAST(round(timestampdiff(SECOND, last_login, feature_date) / 86400.0D) AS INT), "
                              f"{NEVER_LOGGED_IN})"),
    "events_30d": "CAST(coalesce(events_30d, 0) AS BIGINT)",
    "failed_payments_30d": "CAST(coalesce(failed_payments_30d, 0) AS BIGINT)",
    "total_spend_90d": "coalesce(spend_micros_90d, 0) / 1000000D",
    "refunds_30d": "CAST(coalesce(refunds_30d, 0) AS BIGINT)",
    "is_pro_plan": "CAST(CASE WHEN plan_type = 'pro' THEN 1 ELSE 0 END AS INT)",
    "is_paid_plan": "CAST(CASE WHEN plan_type IN ('basic', 'pro') THEN 1 ELSE 0 END AS INT)",
    "days_since_signup": "CAST(round(timestampdiff(SECOND, signup_date, feature_date) / 86400.0D) AS INT)",
}


def feature_snapshot(d: Domain, feature_date, features: Sequence[str] = S.FEATURE_COLUMNS,
                     with_label: bool = False, existing_only: bool = False,
                     user_ids: DataFrame | None = None,
                     custom: Sequence[FeatureSpec] = ()) -> DataFrame:
    """All users x chosen features at one date (users without facts are kept)."""
    return feature_grid(d, make_grid(feature_date, 1, 1), features, with_label,
                        existing_only, user_ids, custom)


def training_dataset(d: Domain, start, n: int, step_days: int = 7,
                     existing_only: bool = True) -> DataFrame:
    """Snapshots at start + k*step (k < n) with the churn label, in one pass."""
    return feature_grid(d, make_grid(start, n, step_days), with_label=True, existing_only=existing_only)


def churn_labels(d: Domain, feature_date, user_ids: DataFrame | None = None) -> DataFrame:
    """(user_id, feature_date, churned_30d) for every user at one date."""
    g = make_grid(feature_date, 1, 1)
    return (feature_grid(d, g, features=(), with_label=True, user_ids=user_ids)
            .select("user_id", "feature_date", "churned_30d"))


def training_summary(training: DataFrame) -> DataFrame:
    """Shape, date range and churn rate of a training set (one row), from one
    aggregate per (date, bucket of users) with the users as bitmaps."""
    parts = id_bitmaps(training, ["feature_date"], "user_id", F.count(F.lit(1)).alias("n_rows"),
                       F.sum("churned_30d").alias("churned"), F.count("churned_30d").alias("labelled"))
    users = merged(parts, [], F.sum("n_rows").alias("n_rows"), F.sum("churned").alias("churned"),
                   F.sum("labelled").alias("labelled"), F.min("feature_date").alias("min_date"),
                   F.max("feature_date").alias("max_date"))
    total = distinct_ids(users, [], "n_users", F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
                         F.sum("churned").alias("churned"), F.sum("labelled").alias("labelled"),
                         F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"))
    # one row per date is counted and set beside the one row of the total
    dates = parts.groupBy("feature_date").agg(F.count(F.lit(1)).alias("buckets")).agg(
        F.count("feature_date").alias("n_dates"))
    both = total.unionByName(dates, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in (
        "n_rows", "n_users", "n_dates", "min_date", "max_date", "churned", "labelled")])
    return both.select("n_rows", F.coalesce("n_users", F.lit(0)).alias("n_users"), "n_dates", "min_date", "max_date",
                       F.try_divide("churned", "labelled").alias("churn_rate"))


def split_features_labels(training: DataFrame) -> tuple[DataFrame, DataFrame]:
    feats = training.drop("churned_30d")
    labels = training.select("user_id", "feature_date", "churned_30d")
    return feats, labels


def default_features(requested: DataFrame, vectors: DataFrame) -> DataFrame:
    """Requested users with their vector, or safe defaults when none exists
    (zeros, and 9999 days since the last login)."""
    defaults = {c: 0 for c in S.FEATURE_COLUMNS}
    defaults["days_since_last_login"] = NEVER_LOGGED_IN
    defaults["avg_sessions_7d"] = 0.0
    defaults["total_spend_90d"] = 0.0
    j = requested.select("user_id").join(vectors, "user_id", "left")
    return j.select("user_id", (F.col("feature_date").isNull()).alias("is_default"),
                    *[F.coalesce(F.col(c), F.lit(v)).cast(vectors.schema[c].dataType).alias(c)
                      for c, v in defaults.items()])
