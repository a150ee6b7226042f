"""Per-user state of streams by ``transformWithState``: the latest vector, with
expiry by an event-time timer, and the sticky assignment.

State is kept by key in the state store of the query; a micro-batch reads and
writes the keys it holds, and what changed goes to a changelog. No table is
rewritten. The state lives in RocksDB, so it may be larger than memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_rocksdb(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


class NewestRow(StatefulProcessor):
    """Keeps each key's row of the largest ``order`` (a long); passes a row on when
    it replaces the one kept. With ``ttl_ms`` a kept row expires that long after
    ``time_ms`` (a column of epoch milliseconds): an event-time timer clears the
    state and passes the row on with ``expired`` set. Ties keep the row that came
    first."""

    def __init__(self, columns: list[str], schema: T.StructType, order: str, time_ms: str, ttl_ms: int | None):
        self.columns, self.schema, self.names = columns, schema, schema.fieldNames()
        self.order, self.time_ms, self.ttl_ms = order, time_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.row = handle.getValueState("row", self.schema)

    def _kept(self) -> dict | None:
        return dict(zip(self.names, self.row.get())) if self.row.exists() else None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = self._kept()
        new = kept
        for frame in rows:
            frame.columns = self.columns  # frames come with names that Python allows
            best = frame.loc[frame[self.order].idxmax()]
            if new is None or int(best[self.order]) > new[self.order]:
                new = {n: _plain(best[n], f.dataType) for n, f in zip(self.names, self.schema)}
        if new is not kept:
            self.row.update(tuple(new[n] for n in self.names))
            if self.ttl_ms is not None:
                if kept is not None:
                    self.handle.deleteTimer(kept[self.time_ms] + self.ttl_ms)
                self.handle.registerTimer(new[self.time_ms] + self.ttl_ms)
            yield _frame(new, self.schema, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        kept = self._kept()
        if kept is not None and kept[self.time_ms] + self.ttl_ms <= expiredTimerInfo.getExpiryTimeInMs():
            self.row.clear()
            yield _frame(kept, self.schema, True)

    def close(self) -> None:
        pass


class FirstRow(StatefulProcessor):
    """Passes on the first row of each key ever seen; keys of the initial state
    are known from the start."""

    def __init__(self, schema: T.StructType, order: str):
        self.columns, self.schema, self.names, self.order = schema.fieldNames(), schema, schema.fieldNames(), order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "known boolean")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.known.update((True,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.known.exists():
            return
        first = None
        for frame in rows:
            frame.columns = self.columns  # frames come with names that Python allows
            best = frame.loc[frame[self.order].idxmin()]
            if first is None or int(best[self.order]) < first[self.order]:
                first = {n: _plain(best[n], f.dataType) for n, f in zip(self.names, self.schema)}
        if first is not None:
            self.known.update((True,))
            yield _frame(first, self.schema, None)

    def close(self) -> None:
        pass


_PANDAS = {T.LongType(): "Int64", T.IntegerType(): "Int32", T.BooleanType(): "boolean"}


def _plain(value, kind: T.DataType):
    if value is None or value is pd.NA or (isinstance(value, float) and value != value and not isinstance(kind, T.DoubleType)):
        return None
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return int(value)
    if isinstance(kind, T.DoubleType):
        return None if value != value else float(value)
    if isinstance(kind, T.BooleanType):
        return bool(value)
    return value


def _frame(row: dict, schema: T.StructType, expired: bool | None) -> pd.DataFrame:
    out = {f.name: pd.Series([row[f.name]], dtype=_PANDAS.get(f.dataType, "float64" if f.dataType == T.DoubleType() else object))
           for f in schema}
    if expired is not None:
        out["expired"] = pd.Series([expired])
    return pd.DataFrame(out)


def newest_rows(stream: DataFrame, key: str, order: str, time_ms: str, event_time: str, ttl_ms: int | None = None) -> DataFrame:
    """Changes of each key's newest row, as ``stream``'s columns without
    ``event_time`` and with ``expired``. ``stream`` has a watermark on ``event_time``."""
    schema = T.StructType([f for f in stream.schema if f.name != event_time])
    out = T.StructType([*schema.fields, T.StructField("expired", T.BooleanType())])
    return stream.groupBy(key).transformWithStateInPandas(
        NewestRow(stream.columns, schema, order, time_ms, ttl_ms), out, "Update", "EventTime")


def first_rows(stream: DataFrame, keys: list[str], order: str, known: DataFrame) -> DataFrame:
    """The first row of each key that neither the stream nor ``known`` (a batch
    table of keys) held before."""
    return stream.groupBy(*keys).transformWithStateInPandas(
        FirstRow(stream.schema, order), stream.schema, "Update", "None", known.select(*keys).groupBy(*keys))
