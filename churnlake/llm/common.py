"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor loses nothing of it), keeps results of
    non-deterministic order fixed, and gives the planner true sizes.
    """
    spark = df.sparkSession
    path = f"{scratch_path(spark, name)}/t"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs deleted. Spark's cleaner does that once
    the driver's JVM has collected what refers to them, which may be long after."""
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Return to the system what a Python worker has freed. Idle workers stay for the
    next stages and would hold it beside theirs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def fresh(df: DataFrame, name: str, *endings: str) -> str:
    """A column name that is not in ``df``, nor is it with any of ``endings`` (extra
    input columns may clash with ours)."""
    taken = {c.lower() for c in df.columns}
    while any((name + e).lower() in taken for e in ("", *endings)):
        name += "_"
    return name


def parallelism(df: DataFrame) -> int:
    """Partitions for an explicit shuffle: the session's own shuffle setting."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def buckets_for(rows: Column, rows_per_bucket: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(rows / F.lit(rows_per_bucket))).cast("long")


def prefix_sums(df: DataFrame, group: list[str], bucket: str, order: list[str], weight: str, out: str) -> DataFrame:
    """Sum of ``weight`` over the rows of the same group that come before a row.

    Rows of a group are cut into ascending ``bucket`` values. Bucket totals get
    their offsets from a window over one row per bucket; inside a bucket a plain
    running sum is taken. No task sees a whole group, only one bucket of it, so
    callers choose buckets of a fixed row count. ``group`` must hold no nulls.
    """
    tot = df.groupBy(*group, bucket).agg(F.sum(weight).alias("_tot"))
    w = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    base = tot.select(*group, bucket, F.coalesce(F.sum("_tot").over(w), F.lit(0)).alias("_base"))
    inner = (Window.partitionBy(*group, bucket).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (df.withColumn("_run", F.sum(weight).over(inner) - F.col(weight))
            .join(base, [*group, bucket])
            .withColumn(out, F.col("_run") + F.col("_base")).drop("_run", "_base"))
