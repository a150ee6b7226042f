"""Streaming = batch, late rows dropped by the watermark, duplicates removed."""
import tempfile

from pyspark.sql import functions as F

from churnlake.operators import monitor as M
from churnlake.sources import schemas as S
from churnlake.streaming import jobs as J
from frames import T


def _pred(i, t, p=0.3):
    return (i, i % 7, p, int(p >= 0.5), T(t), None, "1.0" if i % 2 == 0 else "2.0", float(i % 5), i % 3 != 0, False)


def _land(spark, rows, path, name="part"):
    df = spark.createDataFrame(rows, S.PREDICTIONS)
    J.write_landing(df, path, F.to_date("prediction_time"), name)
    return df


def _folders():
    return [tempfile.mkdtemp(prefix=p) for p in ("land-", "sink-", "ckpt-")]


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_hourly_equals_batch_out_of_order(spark):
    rows = [_pred(i, f"2024-01-{1 + (i * 7) % 9:02d} {(i * 5) % 24:02d}:{i % 60:02d}:00", (i % 10) / 10) for i in range(300)]
    land, sink, ckpt = _folders()
    df = _land(spark, rows[:200], land)
    J.streaming_hourly_metrics(spark, land, S.PREDICTIONS, sink, ckpt, max_files=2)
    df = df.unionByName(_land(spark, rows[200:], land, name="second"))
    got = J.streaming_hourly_metrics(spark, land, S.PREDICTIONS, sink, ckpt, max_files=2)
    from churnlake.plans.registry import rounded
    want = rounded(M.hourly_metrics(df))   # sums are added in another order
    assert _same(rounded(got.select(want.columns)), want)
    assert J.late_rows(spark, land, S.PREDICTIONS, got) == 0


def test_late_rows_are_dropped_and_counted(spark):
    land, sink, ckpt = _folders()
    _land(spark, [_pred(i, f"2024-01-20 {i % 24:02d}:00:00") for i in range(50)], land)
    J.streaming_hourly_metrics(spark, land, S.PREDICTIONS, sink, ckpt, watermark="1 day")
    _land(spark, [_pred(100 + i, "2024-01-10 05:00:00") for i in range(7)], land)
    got = J.streaming_hourly_metrics(spark, land, S.PREDICTIONS, sink, ckpt, watermark="1 day")
    assert got.filter(F.col("metric_date") == F.lit("2024-01-10").cast("date")).count() == 0
    assert got.agg(F.sum("total_predictions")).collect()[0][0] == 50
    assert J.late_rows(spark, land, S.PREDICTIONS, got) == 7


def test_ingest_goes_on_where_it_stopped(spark):
    land, sink, ckpt = _folders()
    _land(spark, [_pred(i, "2024-01-02 01:00:00") for i in range(20)], land)
    assert J.ingest(spark, land, S.PREDICTIONS, sink, ckpt).count() == 20
    assert J.ingest(spark, land, S.PREDICTIONS, sink, ckpt).count() == 20
    _land(spark, [_pred(100 + i, "2024-01-03 01:00:00") for i in range(5)], land)
    assert J.ingest(spark, land, S.PREDICTIONS, sink, ckpt).count() == 25


def test_duplicates_within_watermark_are_dropped(spark):
    rows = [_pred(i, f"2024-01-{1 + i % 5:02d} 01:00:00") for i in range(40)]
    land, sink, ckpt = _folders()
    _land(spark, rows, land)
    J.streaming_dedupe(spark, land, S.PREDICTIONS, ["prediction_id"], sink, ckpt)
    _land(spark, rows[:15], land, name="copy")
    out = J.streaming_dedupe(spark, land, S.PREDICTIONS, ["prediction_id"], sink, ckpt)
    assert out.count() == 40 and out.select("prediction_id").distinct().count() == 40


def test_latest_vectors_are_state_and_only_changes_are_written(spark):
    schema = "user_id long, feature_date timestamp_ntz, x double, n int"
    land, sink, ckpt = _folders()
    row = lambda u, d, x: (u, T(f"2024-01-{d:02d} 00:00:00"), x, None if u % 2 else u)
    first = spark.createDataFrame([row(u, 1, 1.0) for u in range(50)], schema)
    J.write_landing(first, land, F.to_date("feature_date"))
    J.streaming_latest_vectors(spark, land, first.schema, sink, ckpt)
    before = J._numbered(spark, f"{sink}/changes", "batch_id")
    more = [row(3, 2, 9.0), row(3, 1, 0.0), row(4, 1, 5.0), row(60, 3, None)]
    J.write_landing(spark.createDataFrame(more, schema), land, F.to_date("feature_date"), name="second")
    got = J.streaming_latest_vectors(spark, land, first.schema, sink, ckpt)
    assert got.columns == first.columns
    assert {tuple(r) for r in got.collect()} == {row(u, 1, 1.0) for u in range(50) if u != 3} | {row(3, 2, 9.0), row(60, 3, None)}
    new = [n for n in J._numbered(spark, f"{sink}/changes", "batch_id") if n not in before]
    changed = [r["user_id"] for n in new for r in spark.read.parquet(f"{sink}/changes/batch_id={n}").collect()]
    assert sorted(changed) == [3, 60]  # of one batch a user is one row; what did not change is not written


def test_vectors_expire_by_the_streams_clock(spark):
    schema = "user_id long, feature_date timestamp_ntz, x double"
    land, sink, ckpt = _folders()
    day = lambda u, d: (u, T(f"2024-01-{d:02d} 00:00:00"), float(d))
    # the clock is three days behind the newest row; a vector expires two days after its date
    deliveries = [[day(1, 1), day(2, 1), day(3, 5)], [day(2, 4)], [day(4, 5), day(5, 7)], [day(6, 11), day(3, 2)]]
    want = [{1, 2, 3}, {1, 2, 3}, {2, 3, 4, 5}, {5, 6}]
    for i, (rows, left) in enumerate(zip(deliveries, want)):
        df = spark.createDataFrame(rows, schema)
        J.write_landing(df, land, F.to_date("feature_date"), name=f"d{i}")
        got = J.streaming_latest_vectors(spark, land, df.schema, sink, ckpt, ttl_hours=48,
                                         watermark="3 days")
        assert {r["user_id"] for r in got.collect()} == left, i


def test_changelog_is_folded_into_a_base(spark):
    land, sink, ckpt = _folders()
    rows = [_pred(i, f"2024-01-{1 + i % 9:02d} {i % 24:02d}:00:00", (i % 10) / 10) for i in range(200)]
    df = _land(spark, rows, land)
    got = J.streaming_hourly_metrics(spark, land, S.PREDICTIONS, sink, ckpt, max_files=1)
    bases = J._numbered(spark, f"{sink}/base", "upto")
    assert len(J._numbered(spark, f"{sink}/changes", "batch_id")) >= J.COMPACT_AFTER and len(bases) == 1
    from churnlake.plans.registry import rounded
    want = rounded(M.hourly_metrics(df))
    assert _same(rounded(got.select(want.columns)), want)
    df = df.unionByName(_land(spark, [_pred(900, "2024-01-09 01:00:00")], land, name="second"))
    got = J.streaming_hourly_metrics(spark, land, S.PREDICTIONS, sink, ckpt)
    assert J._numbered(spark, f"{sink}/base", "upto") == bases
    assert _same(rounded(got.select(want.columns)), rounded(M.hourly_metrics(df)))


def test_outcomes_join_within_thirty_days_and_leave_the_state(spark):
    log_land, sink, ckpt = _folders()
    seen_land = tempfile.mkdtemp(prefix="seen-")
    seen_schema = "user_id long, observed_at timestamp_ntz, actual_churned int"
    log = [_pred(i, f"2024-01-{1 + i % 28:02d} 0{i % 9}:00:00") for i in range(120)]
    seen = [(1, T("2024-01-25 00:00:00"), 1), (2, T("2024-01-10 00:00:00"), 0), (3, T("2024-02-20 00:00:00"), 1)]
    run = lambda: J.streaming_outcomes(spark, log_land, S.PREDICTIONS, seen_land, obs.schema, sink, ckpt)
    df = _land(spark, log, log_land)
    obs = spark.createDataFrame(seen, seen_schema)
    J.write_landing(obs, seen_land, F.to_date("observed_at"))
    got = run()
    want = M.outcome_backfill(df, obs)
    assert _same(got.select(want.columns), want)
    # later rows on both streams move the watermarks past the window: what waited is final
    late = [_pred(500, "2024-05-01 00:00:00"), _pred(501, "2024-05-03 00:00:00")]
    df = df.unionByName(_land(spark, late[:1], log_land, name="second"))
    extra = spark.createDataFrame([(6, T("2024-05-01 00:00:00"), 0)], seen_schema)
    J.write_landing(extra, seen_land, F.to_date("observed_at"), name="second")
    run()
    df = df.unionByName(_land(spark, late[1:], log_land, name="third"))
    obs = obs.unionByName(extra)
    got = run()
    want = M.outcome_backfill(df, obs)
    assert _same(got.select(want.columns), want)
    assert spark.read.parquet(sink).count() >= 120  # the old ones are in the sink, not in the state


def test_assignment_of_any_test_is_sticky_across_calls(spark):
    land, sink, ckpt = _folders()
    tests = spark.createDataFrame([("blue", 0.5, "active", "c", "v"), ("red", 0.5, "paused", "c", "v")],
                                  "test_name string, traffic_split double, status string, control_version string, "
                                  "variant_version string")
    old = spark.createDataFrame([(1, "blue", "variant", "c", "v", T("2023-01-01 00:00:00"))],
                                "user_id long, test_name string, variant string, control_version string, "
                                "variant_version string, assigned_at timestamp_ntz")
    who = lambda b: b.select("user_id", F.col("prediction_time").alias("first_seen"),
                             F.explode(F.array(F.lit("blue"), F.lit("red"))).alias("test_name"))
    run = lambda: J.streaming_assign(spark, land, S.PREDICTIONS, tests, who, old, sink, ckpt)
    _land(spark, [_pred(i, "2024-01-02 01:00:00") for i in range(4)], land)
    first = run()
    a = {(r["user_id"], r["test_name"]): (r["variant"], r["source"]) for r in first.collect()}
    _land(spark, [_pred(i, "2024-01-03 01:00:00") for i in range(7)], land, name="second")
    b = {(r["user_id"], r["test_name"]): (r["variant"], r["source"]) for r in run().collect()}
    assert len(b) == 14 and a.items() <= b.items() and b[(1, "blue")] == ("variant", "existing")
    assert all(v == "control" for (u, t), (v, _) in b.items() if t == "red")


def test_stream_sessions_equal_batch(spark):
    ev = [(u, T(f"2024-01-0{1 + k // 5} {k % 5 * 4:02d}:{(u * 13) % 60:02d}:00")) for u in range(4) for k in range(25)]
    ev += [(0, T("2024-01-01 00:10:00")), (0, T("2024-01-01 00:40:00")),   # exactly 30 min: same session
           (2, T("2024-01-05 10:00:00")), (2, T("2024-01-05 10:30:00.5")),  # 30 min 0.5 s: new session
           (-1, T("2024-01-01 23:50:00")), (-1, T("2024-01-02 00:05:00"))]  # crosses the hour/day chunk
    df = spark.createDataFrame(ev, "user_id long, event_time timestamp_ntz")
    batch = J.sessions_table(J.sessionize(df))
    land, sink, ckpt = _folders()
    cut = F.lit("2024-01-03 00:00:00").cast("timestamp_ntz")
    cols = ["user_id", "session_start", "session_end", "events"]
    for part in (df.filter(F.col("event_time") < cut), df.filter(F.col("event_time") >= cut)):
        J.write_landing(part, land, F.to_date("event_time"))
        stream = J.streaming_sessions(spark, land, df.schema, sink, ckpt)
    assert stream.filter("closed").count() > 0 and stream.filter("not closed").count() > 0
    assert _same(batch.select(cols), stream.select(cols))
    # more events land later, as a sentinel in the far future would have prevented
    J.write_landing(spark.createDataFrame([(9, T("2024-01-06 10:00:00"))], df.schema), land, F.to_date("event_time"))
    assert J.streaming_sessions(spark, land, df.schema, sink, ckpt).count() == batch.count() + 1
    # the naive single-window form agrees with the chunked form
    from pyspark.sql import Window
    w = Window.partitionBy("user_id").orderBy("event_time")
    gap = F.timestamp_diff("MICROSECOND", F.lag("event_time").over(w), F.col("event_time"))
    naive = (df.withColumn("n", F.when(gap.isNull() | (gap > 1800 * 10**6), 1).otherwise(0))
             .withColumn("session_number", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
             .select("user_id", "event_time", "session_number"))
    chunked = J.sessionize(df)
    assert naive.exceptAll(chunked).count() == 0 and chunked.exceptAll(naive).count() == 0


def test_wallclock_round_trip(spark):
    df = spark.createDataFrame([(T("2024-03-10 02:30:00.123456"),)], "t timestamp_ntz")
    back = df.select(J.to_wallclock(J.to_instant(F.col("t"))).alias("b")).collect()[0]["b"]
    assert back == T("2024-03-10 02:30:00.123456")


def test_chunked_sessionize_matches_naive_random(spark):
    """Random timelines (gaps around the 30-minute limit, chunk edges): the
    hour-chunked sessionizer equals the single-window definition."""
    import random
    from pyspark.sql import Window
    rnd = random.Random(7)
    rows = []
    for u in range(5):
        t = T("2024-01-01 00:00:00")
        for _ in range(120):
            step = rnd.choice([60, 600, 1799, 1800, 1801, 3600, 7200, 86400]) + rnd.random()
            t = t + __import__("datetime").timedelta(seconds=step)
            rows.append((u, t))
    df = spark.createDataFrame(rows, "user_id long, event_time timestamp_ntz")
    w = Window.partitionBy("user_id").orderBy("event_time")
    gap = F.timestamp_diff("MICROSECOND", F.lag("event_time").over(w), F.col("event_time"))
    naive = (df.withColumn("n", F.when(gap.isNull() | (gap > 1800 * 10**6), 1).otherwise(0))
             .withColumn("session_number", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
             .select("user_id", "event_time", "session_number"))
    for chunk in ("HOUR", "DAY"):
        got = J.sessionize(df, chunk=chunk)
        assert naive.exceptAll(got).count() == 0 and got.exceptAll(naive).count() == 0
