"""Per-user state carried from one snapshot to the next.

The last login of a user needs the whole history. Kept as a table of one row per
user, partitioned by the date it is complete up to, it needs only the logins since
the state before; a snapshot then reads no login at all beyond those.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.functions.timefn import to_python_date
from churnlake.operators import features as FE
from churnlake.sources.store import read_store, table_exists, write_snapshots
from churnlake.sources.tables import Domain

LOGIN_STATE = "user_id long, last_login timestamp_ntz, as_of date"


def logins_between(events: DataFrame, since: dt.date | None, until: dt.date) -> DataFrame:
    """Each user's last login in [since, until); ``since`` None: from the start."""
    got = events.filter(f"event_type = 'login' AND event_time < TIMESTAMP_NTZ'{until.isoformat()} 00:00:00'")
    if since is not None:
        got = got.filter(f"event_time >= TIMESTAMP_NTZ'{since.isoformat()} 00:00:00'")
    return got.groupBy("user_id").agg(F.max("event_time").alias("last_login"))


def advanced(state: DataFrame | None, events: DataFrame, since: dt.date | None, until: dt.date) -> DataFrame:
    """(user_id, last_login) before ``until``, from the state before ``since``."""
    new = logins_between(events, since, until)
    if state is None:
        return new
    return (state.select("user_id", "last_login").unionByName(new)
            .groupBy("user_id").agg(F.max("last_login").alias("last_login")))


def newest_state(spark: SparkSession, path: str, until: dt.date) -> tuple[DataFrame, dt.date] | None:
    """The stored state of the latest date up to ``until``. Dates are read from the
    partitions' names; one row per snapshot."""
    if not table_exists(spark, path):
        return None
    table = spark.read.schema(LOGIN_STATE).parquet(path)
    last = table.filter(F.col("as_of") <= F.lit(until)).agg(F.max("as_of")).first()[0]
    return None if last is None else (table.filter(F.col("as_of") == F.lit(last)).select("user_id", "last_login"), last)


def advance_login_state(spark: SparkSession, events: DataFrame, path: str, date) -> DataFrame:
    """Bring the stored state up to ``date`` and return it. The newest state up to
    that date is read with a partition filter, and only logins since then; without
    one the history is read once. A date that is stored already reads no event."""
    until = to_python_date(date)
    have = newest_state(spark, path, until)
    if have is None or have[1] != until:
        state = advanced(have and have[0], events, have and have[1], until)
        write_snapshots(state.withColumn("as_of", F.lit(until)), path, ("as_of",))
    return newest_state(spark, path, until)[0]


def snapshot_chain(spark: SparkSession, d: Domain, dates: Sequence, store: str, state: str,
                   features: Sequence[str] = FE.S.FEATURE_COLUMNS) -> DataFrame:
    """Snapshots of ascending ``dates`` written to the offline store, each from the
    login state of its date. The bounds of every other feature are its window's."""
    for date in dates:
        logins = advance_login_state(spark, d.user_events, state, date)
        snap = FE.feature_grid(d, FE.make_grid(date, 1, 1), features, login_state=(logins, date))
        write_snapshots(snap, store)
    return read_store(spark, store)
