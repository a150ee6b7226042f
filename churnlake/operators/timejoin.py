"""Joins over time without a range join per key.

* ``asof_join``: each left row with the right row of its key that was valid then.
  Both timelines are united and cut into (key, time bucket). The last right time
  at or before a row is carried on inside its bucket; one summary row per bucket
  carries it across buckets. Knowing the right time, the values come by an
  equi-join on (key, time). A key that owns a third of all rows is as many groups
  as it has buckets, and the final join's large side can be split.
* ``interval_join``: points within [start, end) of their key. An interval is split
  on the time buckets it touches, so that the join is an equi-join on (key,
  bucket) with the exact bounds as its residual condition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
              values: Sequence[str], bucket: str = "DAY", matched: str = "matched_time") -> DataFrame:
    """``left`` with ``matched`` (the largest ``right_time`` <= ``left_time`` of its
    keys) and the ``values`` of that right row; null where there is none.

    ``right`` must be unique on keys and time. Rows whose key or time is null
    match nothing; left rows are kept, repeated ones too. Names of ``values`` must
    not be columns of ``left``. ``bucket`` (a unit of ``date_trunc``) decides how
    finely a key's timeline is split, not the result."""
    keys = list(keys)
    clash = {c for c in (*values, matched) if c in left.columns}
    if clash:
        raise ValueError(f"left already has {sorted(clash)}")
    row = F.struct(*[F.col(c) for c in left.columns])
    r = right.dropna(subset=[*keys, right_time])
    both = (left.select(*keys, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), row.alias("_row"))
            .unionByName(r.select(*keys, F.col(right_time).alias("_t"), F.lit(0).alias("_side")),
                         allowMissingColumns=True)
            .withColumn("_b", F.date_trunc(bucket, "_t")))
    seen = F.when(F.col("_side") == 0, F.col("_t"))
    ends = both.groupBy(*keys, "_b").agg(F.max(seen).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_b").alias("_kb"),
                          F.max("_end").over(before).alias("_carry"))
    inside = Window.partitionBy(*keys, "_b").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    rows = both.withColumn("_in", F.max(seen).over(inside)).filter("_side = 1")
    same = F.col("_b").eqNullSafe(F.col("_kb"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    found = rows.join(carried, same, "left").select("_row.*", F.coalesce("_in", "_carry").alias(matched))
    v = r.select(*keys, F.col(right_time).alias(matched), *values)
    return found.join(v, [*keys, matched], "left").select(*left.columns, matched, *values)


def interval_join(points: DataFrame, intervals: DataFrame, keys: Sequence[str], time: str, start: str, end: str,
                  bucket_seconds: int, how: str = "inner") -> DataFrame:
    """``points`` with the ``intervals`` of their keys that hold their ``time``
    (``start`` <= time < ``end``); ``how`` is inner, left, left_semi or left_anti.

    An interval is repeated for each bucket of ``bucket_seconds`` it touches, so a
    pair meets in one bucket only: choose buckets about as long as the usual
    interval. Null keys, times and bounds match nothing; columns other than the
    keys must have different names on both sides."""
    keys = list(keys)

    def bucket(t):
        return F.floor(F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), t)
                       / F.lit(bucket_seconds))

    p = points.withColumn("_bucket", bucket(F.col(time)))
    # the last bucket is that of the last instant inside: the end itself is outside
    stop = F.col(end) - F.expr("INTERVAL '0.000001' SECOND")
    i = (intervals.filter(F.col(start) < F.col(end))
         .withColumn("_bucket", F.explode(F.sequence(bucket(F.col(start)), bucket(stop)))))
    i = i.select(*[F.col(k).alias(f"_i_{k}") for k in keys], F.col("_bucket").alias("_i_bucket"),
                 *[F.col(c) for c in intervals.columns if c not in keys])
    on = (F.col("_bucket") == F.col("_i_bucket")) & (F.col(time) >= F.col(start)) & (F.col(time) < F.col(end))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_i_{k}"))
    out = p.join(i, on, how).drop("_bucket", "_i_bucket", *[f"_i_{k}" for k in keys])
    return out
