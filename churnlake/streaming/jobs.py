"""Structured Streaming forms of the ingest, metrics, store and assignment jobs
(SURVEY §2.J), plus the batch sessionizer they are checked against.

Every job takes the folder it watches, its sink and its checkpoint, runs with
``trigger(availableNow=True)`` until it has read all files, and can be called
again with the same folders: it then reads only files that landed since. Parquet
sinks commit through the checkpoint; ``foreachBatch`` sinks are idempotent, so a
batch that is run again after a failure replaces what it wrote.

Event time: the tables hold ``timestamp_ntz``; watermarks need ``timestamp``.
The conversion goes through epoch microseconds so it does not depend on the
session time zone, and windows align to UTC hours / days.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.operators import abtest as AB
from churnlake.operators.timejoin import interval_join
from churnlake.streaming.stateful import first_rows, newest_rows, with_rocksdb

SESSION_GAP_SECONDS = 1800
COMPACT_AFTER = 8  # batches of a changelog before they are folded into its base


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())


def to_instant(ntz: Column) -> Column:
    """timestamp_ntz (UTC wall clock) -> timestamp, zone independent."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), ntz))


def to_wallclock(instant: Column) -> Column:
    """timestamp -> timestamp_ntz (UTC wall clock), zone independent."""
    secs = (F.unix_micros(instant) / F.lit(1_000_000)).cast("decimal(18,6)")
    return _epoch() + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of its own for a streaming query. A new checkpoint fixes the
    number of state-store partitions from the shuffle setting; it is sized to the
    cluster's parallelism here, without touching the caller's session."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism))
    return own


def _run(writer, checkpoint: str):
    """Process everything that has landed, then stop."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def write_landing(df: DataFrame, path: str, partition_col: Column, name: str = "part") -> None:
    """Land a table as many files (one folder per value of ``partition_col``),
    the way an upstream writer would drop them."""
    df.withColumn(name, partition_col).write.mode("append").partitionBy(name).parquet(path)


def read_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def landed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows below the watched folder, as a batch."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


# --- J1 ingest ------------------------------------------------------------------------

def ingest(spark: SparkSession, landing: str, schema: T.StructType, sink: str, checkpoint: str,
           max_files: int | None = None) -> DataFrame:
    """File source -> parquet sink, exactly once through the checkpoint."""
    s = read_stream(stream_session(spark), landing, schema, max_files)
    _run(s.writeStream.format("parquet").option("path", sink), checkpoint)
    return spark.read.schema(schema).parquet(sink)


# --- changelogs -----------------------------------------------------------------------------

def changelog_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Writes each micro-batch's changed rows to a folder of its own; a batch that
    is run again replaces it."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")
    return write


def _numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the complete folders ``path/prefix=N``, ascending."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    made = [n for n in names if n.startswith(f"{prefix}=")]
    done = [n for n in made if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in done)


def read_changelog(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The latest version of every key: the newest base and the batches after it.
    Each column is picked by the largest batch number, in one hash aggregate that
    combines map-side."""
    bases = _numbered(spark, f"{path}/base", "upto")
    upto = bases[-1] if bases else -1
    reads = [(f"{path}/base/upto={upto}", -1)] if bases else []
    reads += [(f"{path}/changes/batch_id={n}", n) for n in _numbered(spark, f"{path}/changes", "batch_id") if n > upto]
    log = None
    for folder, n in reads:
        part = spark.read.schema(schema).parquet(folder).withColumn("_batch", F.lit(n).cast("long"))
        log = part if log is None else log.unionByName(part)
    if log is None:
        return spark.createDataFrame([], schema)
    vals = [c for c in schema.fieldNames() if c not in keys]
    return log.groupBy(*keys).agg(*[F.max_by(c, "_batch").alias(c) for c in vals]).select(*schema.fieldNames())


def compact_changelog(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
                      after: int = COMPACT_AFTER) -> None:
    """Fold the changelog into a new base once ``after`` batches follow the last
    one, so that a read never goes back to the first batch. Readers take a base
    when it is complete; the batches stay as they are."""
    bases, batches = _numbered(spark, f"{path}/base", "upto"), _numbered(spark, f"{path}/changes", "batch_id")
    new = [n for n in batches if n > (bases[-1] if bases else -1)]
    if len(new) >= after:
        read_changelog(spark, path, schema, keys).write.mode("overwrite").parquet(f"{path}/base/upto={new[-1]}")


def _run_changelog(spark: SparkSession, changes: DataFrame, path: str, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """Run an update-mode query into the changelog at ``path`` and read its state."""
    _run(changes.writeStream.outputMode("update").foreachBatch(changelog_writer(path)), checkpoint)
    compact_changelog(spark, path, changes.schema, keys)
    return read_changelog(spark, path, changes.schema, keys)


# --- J2 / J3 hourly metrics on a stream ----------------------------------------------------

def hourly_partials(stream: DataFrame, watermark: str) -> DataFrame:
    """Mergeable hourly partials per (hour window, version) under a watermark."""
    ev = stream.withColumn("et", to_instant(F.col("prediction_time"))).withWatermark("et", watermark)
    lab = F.col("predicted_label")
    return (ev.groupBy(F.window("et", "1 hour").alias("w"), "model_version")
            .agg(F.count(F.lit(1)).alias("total_predictions"),
                 F.count_if(lab == 1).alias("positive_predictions"),
                 F.count_if(lab == 0).alias("negative_predictions"),
                 F.sum("churn_probability").alias("sum_probability"),
                 F.sum("latency_ms").alias("sum_latency_ms"),
                 F.count_if(F.col("from_cache")).alias("cache_hits"))
            .select(to_wallclock(F.col("w.start")).alias("hour_start"), "model_version", "total_predictions",
                    "positive_predictions", "negative_predictions", "sum_probability", "sum_latency_ms",
                    "cache_hits"))


def finish_hourly(partials: DataFrame) -> DataFrame:
    n = F.col("total_predictions")
    return partials.select(F.to_date("hour_start").alias("metric_date"), F.hour("hour_start").alias("metric_hour"),
                           "model_version", "total_predictions", "positive_predictions", "negative_predictions",
                           (F.col("sum_probability") / n).alias("avg_probability"),
                           (F.col("sum_latency_ms") / n).alias("avg_latency_ms"),
                           (F.col("cache_hits") / n).alias("cache_hit_rate"))


def streaming_hourly_metrics(spark: SparkSession, landing: str, schema: T.StructType, sink: str, checkpoint: str,
                             watermark: str = "31 days", max_files: int | None = None) -> DataFrame:
    """Update-mode windowed aggregation into a changelog; returns the folded
    metrics table of all calls so far."""
    own = stream_session(spark)
    return finish_hourly(_run_changelog(spark, hourly_partials(read_stream(own, landing, schema, max_files), watermark),
                                        sink, checkpoint, ["hour_start", "model_version"]))


def late_rows(spark: SparkSession, landing: str, schema: T.StructType, metrics: DataFrame) -> int:
    """Rows that landed but are in no metric because they were late: a count over
    the tables, complete however many batches or calls there were."""
    seen = metrics.agg(F.coalesce(F.sum("total_predictions"), F.lit(0)).alias("n")).first()["n"]
    return landed(spark, landing, schema).count() - int(seen)


# --- J4 latest vectors ------------------------------------------------------------------

def streaming_latest_vectors(spark: SparkSession, landing: str, schema: T.StructType, sink: str, checkpoint: str,
                             max_files: int | None = None, ttl_hours: int | None = None,
                             watermark: str = "0 seconds") -> DataFrame:
    """The newest vector of every user. A vector is per-user state; a micro-batch
    touches the users it holds and adds those that changed to the changelog. With
    ``ttl_hours`` a vector expires that long after its date by the stream's clock
    (an event-time timer), and the user is gone until a newer one lands."""
    own = with_rocksdb(stream_session(spark))
    order, clock = "_order", "_ms"
    s = (read_stream(own, landing, schema, max_files).withColumn("_et", to_instant(F.col("feature_date")))
         .withWatermark("_et", watermark)
         .withColumns({order: F.unix_micros("_et"), clock: F.unix_millis("_et")}))
    plain = s.drop("feature_date")  # the state holds the date as its number
    changes = newest_rows(plain, "user_id", order, clock, "_et", None if ttl_hours is None else ttl_hours * 3_600_000)
    log = _run_changelog(spark, changes, sink, checkpoint, ["user_id"])
    date = to_wallclock(F.timestamp_micros(F.col(order))).alias("feature_date")
    return log.filter(~F.col("expired")).select(*[date if c == "feature_date" else F.col(c) for c in schema.fieldNames()])


# --- J5 sticky assignment -----------------------------------------------------------------

def streaming_assign(spark: SparkSession, landing: str, schema: T.StructType, tests: DataFrame,
                     candidates: Callable[[DataFrame], DataFrame], existing: DataFrame, sink: str, checkpoint: str,
                     max_files: int | None = None) -> DataFrame:
    """``candidates`` maps log rows to (user_id, test_name, first_seen), without
    aggregating them. A pair is assigned by hash bucket the first time it is met; that
    it has been met is state per pair, which starts from ``existing``. Assignments
    never change, so the sink only grows."""
    own = with_rocksdb(stream_session(spark))
    t = spark.createDataFrame(tests.collect(), tests.schema)  # one row per experiment, as of the call
    new = AB.assign_new(candidates(read_stream(own, landing, schema, max_files)), t)
    at = F.timestamp_diff("MICROSECOND", _epoch(), F.col("assigned_at")).alias("_at")
    named = new.select(*[c for c in new.columns if c != "assigned_at"], at)
    known = spark.createDataFrame([], "user_id long, test_name string").unionByName(existing.select("user_id", "test_name"))
    _run(first_rows(named, ["user_id", "test_name"], "_at", known).writeStream.outputMode("update")
         .foreachBatch(changelog_writer(sink)), checkpoint)
    got = read_changelog(spark, sink, named.schema, ["user_id", "test_name"]).withColumn(
        "assigned_at", to_wallclock(F.timestamp_micros(F.col("_at"))))
    columns = existing.columns
    return (existing.withColumn("source", F.lit("existing"))
            .unionByName(got.select(*columns).withColumn("source", F.lit("new"))).select(*columns, "source"))


# --- J6 sliding activity -------------------------------------------------------------------

def streaming_sliding_counts(spark: SparkSession, landing: str, schema: T.StructType, sink: str, checkpoint: str,
                             days: int = 30, watermark: str = "31 days", max_files: int | None = None) -> DataFrame:
    """Events per user in sliding ``days``-day windows advancing daily; the
    window ending at midnight d is the feature events_{days}d at d. The state
    holds daily counts only; windows are summed from the stored days in batch."""
    ev = read_stream(stream_session(spark), landing, schema, max_files)
    agg = (ev.withColumn("et", to_instant(F.col("event_time"))).withWatermark("et", watermark)
           .groupBy("user_id", F.window("et", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("events"))
           .select("user_id", to_wallclock(F.col("w.start")).alias("day"), "events"))
    daily = _run_changelog(spark, agg, sink, checkpoint, ["user_id", "day"])
    ends = F.transform(F.sequence(F.lit(1), F.lit(days)), lambda k: F.col("day") + F.make_dt_interval(k))
    return (daily.select("user_id", "events", F.explode(ends).alias("feature_date"))
            .groupBy("user_id", "feature_date").agg(F.sum("events").alias("events")))


# --- J7 sessions ----------------------------------------------------------------------------

def sessionize(events: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS, chunk: str = "HOUR") -> DataFrame:
    """Batch sessionization: a new session starts when the gap to the user's
    previous event exceeds ``gap_seconds`` (a session is a burst whose
    consecutive events are at most 30 minutes apart, as ``session_window``).

    Skew-safe: the lag / running count runs per (user, time chunk), so one
    user's history is split over many tasks; chunk summaries (one row per active
    chunk of a user) are then stitched with a second, small window. Returns one
    row per event with a per-user session number starting at 1."""
    t = F.col("event_time")
    ev = events.select("user_id", "event_time", F.date_trunc(chunk, t).alias("chunk"))
    w1 = Window.partitionBy("user_id", "chunk").orderBy("event_time")
    gap = F.timestamp_diff("MICROSECOND", F.lag("event_time").over(w1), t)
    ev = ev.withColumn("_new", F.when(gap.isNull() | (gap > gap_seconds * 1_000_000), 1).otherwise(0))
    ev = ev.withColumn("local", F.sum("_new").over(w1.rowsBetween(Window.unboundedPreceding, 0)))
    summ = ev.groupBy("user_id", "chunk").agg(F.min("event_time").alias("first_t"), F.max("event_time").alias("last_t"),
                                              F.max("local").alias("n_local"))
    w2 = Window.partitionBy("user_id").orderBy("chunk")
    prev_last = F.lag("last_t").over(w2)
    summ = summ.withColumn("cont", F.when(prev_last.isNotNull()
                                          & (F.timestamp_diff("MICROSECOND", prev_last, F.col("first_t"))
                                             <= gap_seconds * 1_000_000), 1)
                           .otherwise(0))
    started = F.col("n_local") - F.col("cont")
    summ = summ.withColumn("base", F.coalesce(F.sum(started).over(w2.rowsBetween(Window.unboundedPreceding, -1)),
                                              F.lit(0)))
    return (ev.join(summ.select("user_id", "chunk", "cont", "base"), ["user_id", "chunk"])
            .select("user_id", "event_time",
                    (F.col("base") + F.col("local") - F.col("cont")).cast("long").alias("session_number")))


def sessions_table(sessionized: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS) -> DataFrame:
    """One row per session: start, end (= last event + gap), events."""
    return (sessionized.groupBy("user_id", "session_number")
            .agg(F.min("event_time").alias("session_start"),
                 (F.max("event_time") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(gap_seconds)))
                 .alias("session_end"),
                 F.count(F.lit(1)).alias("events")))


def streaming_sessions(spark: SparkSession, landing: str, schema: T.StructType, sink: str, checkpoint: str,
                       gap: str = "30 minutes", watermark: str = "2 hours", max_files: int | None = None) -> DataFrame:
    """``session_window`` per user (start, end, events, closed).

    Sessions whose end the watermark has passed are final and come from the sink.
    Rows of sessions still open are sessionised in batch from the watched folder:
    those in no final session, as far as their sessions end after the watermark;
    what ends before it was late and stays out."""
    ev = read_stream(stream_session(spark), landing, schema, max_files)
    agg = (ev.withColumn("et", to_instant(F.col("event_time"))).withWatermark("et", watermark)
           .groupBy("user_id", F.session_window("et", gap).alias("s"))
           .agg(F.count(F.lit(1)).alias("events"))
           .select("user_id", to_wallclock(F.col("s.start")).alias("session_start"),
                   to_wallclock(F.col("s.end")).alias("session_end"), "events"))
    q = _run(agg.writeStream.format("parquet").option("path", sink).outputMode("append"), checkpoint)
    mark = (q.lastProgress or {}).get("eventTime", {}).get("watermark")
    closed = spark.read.schema("user_id long, session_start timestamp_ntz, session_end timestamp_ntz, events long"
                               ).parquet(sink)
    # an equi-join on (user, hour): a busy user's events meet the sessions of their hour only
    left = interval_join(landed(spark, landing, schema), closed.drop("events"), ["user_id"], "event_time",
                         "session_start", "session_end", 3600, "left_anti")
    open_ = sessions_table(sessionize(left)).drop("session_number")
    if mark:
        open_ = open_.filter(F.col("session_end") > F.lit(mark.replace("T", " ").rstrip("Z")).cast("timestamp_ntz"))
    return (closed.withColumn("closed", F.lit(True))
            .unionByName(open_.withColumn("closed", F.lit(False)).select("user_id", "session_start", "session_end",
                                                                         "events", "closed")))


# --- J8 dedupe --------------------------------------------------------------------------------

def streaming_dedupe(spark: SparkSession, landing: str, schema: T.StructType, keys: Sequence[str], sink: str,
                     checkpoint: str, watermark: str = "31 days", max_files: int | None = None) -> DataFrame:
    """Drop repeated keys that arrive within the watermark delay."""
    ev = (read_stream(stream_session(spark), landing, schema, max_files)
          .withColumn("_et", to_instant(F.col("prediction_time"))).withWatermark("_et", watermark)
          .dropDuplicatesWithinWatermark(list(keys)).drop("_et"))
    _run(ev.writeStream.format("parquet").option("path", sink), checkpoint)
    return spark.read.schema(schema).parquet(sink)


# --- outcomes ---------------------------------------------------------------------------------

def streaming_outcomes(spark: SparkSession, log_landing: str, log_schema: T.StructType, outcome_landing: str,
                       outcome_schema: T.StructType, sink: str, checkpoint: str, window_days: int = 30,
                       watermark: str = "1 day", max_files: int | None = None) -> DataFrame:
    """Predictions joined with the outcomes that arrive up to ``window_days`` later:
    a stream-stream interval join under two watermarks, left outer. A prediction is
    state until its outcome comes or the watermark says that none can come; then it
    goes to the sink, once, and out of the state. Returns the log so far as
    ``outcome_backfill`` does: rows of the sink, and those still waiting, unmarked.

    Outcomes are (user_id, observed_at, actual_churned), at most one per user."""
    own = stream_session(spark)
    log = (read_stream(own, log_landing, log_schema, max_files)
           .withColumn("_pt", to_instant(F.col("prediction_time"))).withWatermark("_pt", watermark))
    seen = (read_stream(own, outcome_landing, outcome_schema, max_files)
            .select(F.col("user_id").alias("_user"), "actual_churned", to_instant(F.col("observed_at")).alias("_ot"))
            .withWatermark("_ot", watermark))
    due = F.expr(f"user_id = _user AND _ot >= _pt AND _ot <= _pt + INTERVAL '{int(window_days)}' DAY")
    hit = F.col("_user").isNotNull() & ~F.col("is_monitored")
    keep = [c for c in log_schema.fieldNames() if c != "is_monitored"]
    joined = log.join(seen, due, "leftOuter").select(
        *keep, (F.col("is_monitored") | hit).alias("is_monitored"),
        F.when(hit, F.col("actual_churned")).cast("int").alias("actual_label"))
    _run(joined.writeStream.format("parquet").option("path", sink).outputMode("append"), checkpoint)
    done = spark.read.schema(joined.schema).parquet(sink)
    waiting = landed(spark, log_landing, log_schema).join(done.select("prediction_id"), "prediction_id", "left_anti")
    return done.unionByName(waiting.select(*keep, "is_monitored", F.lit(None).cast("int").alias("actual_label")))
