"""Hand-made churn frames for edge cases."""
from __future__ import annotations

import datetime as dt

from churnlake.sources import schemas as S
from churnlake.sources.tables import Domain


def T(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def domain(spark, users, events=(), billing=()) -> Domain:
    return Domain(spark.createDataFrame(list(users), S.USERS),
                  spark.createDataFrame(list(events), S.USER_EVENTS),
                  spark.createDataFrame(list(billing), S.BILLING_EVENTS))
