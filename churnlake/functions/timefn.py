"""Zone-free time helpers (all event times are ``timestamp_ntz``)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


def ts(value: str | _dt.date | _dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal; independent of the session time zone."""
    if isinstance(value, (_dt.date, _dt.datetime)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(str(value)).cast(TimestampNTZType())


def to_python_date(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value)[:10])
