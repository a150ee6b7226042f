"""Offline feature store and keyed upserts on parquet.

* snapshots are written partitioned by ``feature_date`` with dynamic partition
  overwrite, so recomputing a date replaces exactly that partition (no duplicate
  appends) and reads by date or range are partition-pruned;
* parquet has no MERGE: ``upsert_table`` joins the partitions that the new rows
  touch, writes them to a folder of their own (a plan may not read and overwrite
  one path) and only then replaces those partitions; others keep their files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from churnlake.functions.timefn import ts
from churnlake.session import scratch_path


def write_snapshots(df: DataFrame, path: str, partition_by: Sequence[str] = ("feature_date",)) -> None:
    """Write feature rows, replacing only the partitions present in ``df``
    (per-write dynamic overwrite; the session configuration is not touched)."""
    # Sorting inside each task keeps one open file per partition value and
    # leaves the write parallel; repartitioning by the date would send a
    # whole snapshot to one writer task.
    (df.sortWithinPartitions(*partition_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def with_date_parts(df: DataFrame, col: str = "feature_date") -> DataFrame:
    """year / month / day partition columns for a day-partitioned history."""
    return (df.withColumn("year", F.year(col)).withColumn("month", F.month(col))
            .withColumn("day", F.dayofmonth(col)))


def read_store(spark: SparkSession, path: str, schema=None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    if "feature_date" in df.columns:
        df = df.withColumn("feature_date", F.col("feature_date").cast("timestamp_ntz"))
    return df


def snapshot_for_date(store: DataFrame, date) -> DataFrame:
    """All vectors of one snapshot date (partition filter)."""
    return store.filter(F.col("feature_date") == ts(str(date)[:10]))


def features_in_range(store: DataFrame, start, end) -> DataFrame:
    """``start <= feature_date < end``, ordered by date and user."""
    fd = F.col("feature_date")
    return (store.filter((fd >= ts(str(start)[:10])) & (fd < ts(str(end)[:10])))
            .orderBy("feature_date", "user_id"))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keyed upsert (``ON CONFLICT DO UPDATE`` of every non-key column)."""
    keys = list(keys)
    values = [c for c in old.columns if c not in keys]
    o = old.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in values], F.lit(True).alias("_in_old"))
    n = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in values], F.lit(True).alias("_in_new"))
    j = o.join(n, keys, "full")
    return j.select(*keys, *[F.when(F.col("_in_new"), F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}")).alias(c)
                             for c in values])


def _one_of(column: str, values: Sequence) -> Column:
    known = F.col(column).isin([v for v in values if v is not None])
    return known | F.col(column).isNull() if None in values else known


def upsert_table(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], partition: str) -> DataFrame:
    """Upsert ``new`` into the table at ``path``, which is partitioned by
    ``partition``, one of ``keys``; returns the table.

    Only the partitions with new rows are read and replaced. Their merged rows are
    complete in a scratch folder before the table is touched, and dynamic
    partition overwrite switches them when its job commits, so a lost executor or
    a failed merge leaves the old rows."""
    if partition not in keys:
        raise ValueError("the partition column must be one of the keys")
    merged = new
    if table_exists(spark, path):
        # the values bound the read by a partition filter, which a join would not;
        # they are the new rows' days (or other coarse parts), not their keys
        touched = [r[0] for r in new.select(partition).distinct().collect()]
        old = spark.read.schema(new.schema).parquet(path).select(*new.columns)
        merged = upsert(old.filter(_one_of(partition, touched)), new, keys)
    staged = scratch_path(spark, "upsert")
    merged.write.mode("overwrite").parquet(staged)
    write_snapshots(spark.read.schema(merged.schema).parquet(staged), path, (partition,))
    return spark.read.schema(new.schema).parquet(path).select(*new.columns)


class AuditFailed(ValueError):
    """A staged table that did not pass its checks; ``failures`` says which."""

    def __init__(self, failures: dict):
        super().__init__(f"audit failed: {failures}")
        self.failures = failures


def write_audited(df: DataFrame, path: str, checks: dict[str, tuple[Column, float]], partition_by: Sequence[str] = (
        "feature_date",), unique: Sequence[str] = (), least_rows: int = 1) -> dict:
    """Write, audit, publish. ``df`` is written to a scratch folder while its checks
    are counted as observed metrics of that same pass; only a table that passes
    replaces its partitions at ``path``. Returns the metrics, or raises
    ``AuditFailed`` and leaves ``path`` as it was.

    ``checks``: name -> (condition of a bad row, largest share of bad rows).
    ``unique``: key columns that must not repeat, counted over those columns of the
    staged table, since an observed metric cannot group. ``least_rows``: an empty
    table publishes nothing."""
    seen = Observation("audit")
    metrics = [F.count(F.lit(1)).alias("rows"), *[F.count_if(bad).alias(name) for name, (bad, _) in checks.items()]]
    staged = f"{scratch_path(df.sparkSession, 'audit')}/t"
    df.observe(seen, *metrics).write.parquet(staged)
    table = df.sparkSession.read.schema(df.schema).parquet(staged)
    got = {k: v or 0 for k, v in seen.get.items()}
    failures = {name: got[name] for name, (_, share) in checks.items() if got[name] > share * got["rows"]}
    if got["rows"] < least_rows:
        failures["rows"] = got["rows"]
    if unique:
        again = table.groupBy(*unique).agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("n") - 1)).first()[0] or 0
        got["duplicates"] = again
        if again:
            failures["duplicates"] = again
    if failures:
        raise AuditFailed(failures)
    write_snapshots(table, path, partition_by)
    return got


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, dealt: bool = False) -> DataFrame:
    """``df`` as a catalog table of ``buckets`` files by a hash of ``key``, stored in
    the shared folder. Tables of the same number of buckets are joined by the key
    without a shuffle. Rows are dealt to their buckets first, so that a bucket is
    one file; a join of such tables has its rows there already (``dealt``)."""
    rows = df if dealt else df.repartition(buckets, key)
    (rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", f"{scratch_path(df.sparkSession, name)}/t").saveAsTable(name))
    return df.sparkSession.table(name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a scratch folder of the store and read back: what is
    used several times (feature vectors, a baseline, a report) is computed once."""
    path = f"{scratch_path(df.sparkSession, name)}/t"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds anything, through the Hadoop FileSystem."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(folder)) and len(fs.listStatus(folder)) > 0
