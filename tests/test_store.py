"""Write-audit-publish, pruned upserts and bucketed tables."""
import uuid

import pytest
from pyspark.sql import functions as F

from churnlake.operators import scoring as SC
from churnlake.operators import validate as V
from churnlake.session import scratch_path
from churnlake.sources import store as SR
from frames import T

VECTOR = "user_id long, feature_date timestamp_ntz, events_30d long, is_pro_plan int"


def vectors(spark, rows):
    return spark.createDataFrame([(u, T(f"2024-01-{d:02d} 00:00:00"), e, p) for u, d, e, p in rows], VECTOR)


def test_a_bad_snapshot_leaves_the_store_unchanged(spark):
    path = scratch_path(spark, "audit-test")
    checks = V.audit_checks(["user_id", "feature_date", "events_30d", "is_pro_plan"])
    good = vectors(spark, [(1, 1, 5, 0), (2, 1, 0, 1)])
    got = SR.write_audited(good, path, checks, unique=("user_id", "feature_date"))
    assert got["rows"] == 2 and got["duplicates"] == 0 and not any(v for k, v in got.items() if k != "rows")
    for rows, what in (([(1, 1, -5, 0), (2, 1, 0, 1)], {"range_events_30d": 1}),
                       ([(1, 1, 5, 2), (2, 1, 0, 3)], {"range_is_pro_plan": 2}),
                       ([(None, 1, 5, 0), (2, 1, 0, 1)], {"null_user_id": 1}),
                       ([(1, 1, 5, 0), (1, 1, 6, 0)], {"duplicates": 1}), ([], {"rows": 0})):
        with pytest.raises(SR.AuditFailed) as e:
            SR.write_audited(vectors(spark, rows), path, checks, unique=("user_id", "feature_date"))
        assert e.value.failures == what
        assert sorted(map(tuple, SR.read_store(spark, path).select(*good.columns).collect())) == sorted(
            map(tuple, good.collect()))
    SR.write_audited(vectors(spark, [(9, 2, 1, 0)]), path, checks)
    assert SR.read_store(spark, path).count() == 3


def test_upsert_reads_only_the_partitions_it_touches(spark):
    path = scratch_path(spark, "upsert-test")
    schema = "day date, k long, v long"
    rows = spark.createDataFrame([(None, i, i) for i in range(3)], schema).unionByName(
        spark.range(30).selectExpr("date_add(DATE'2024-01-01', CAST(id % 5 AS INT)) AS day", "id AS k", "id AS v"))
    SR.upsert_table(spark, path, rows, ["day", "k"], "day")
    new = spark.createDataFrame([("2024-01-02", 1, 100), ("2024-01-02", 77, 7)], "d string, k long, v long").selectExpr(
        "CAST(d AS DATE) AS day", "k", "v")
    got = {(str(r["day"]), r["k"]): r["v"] for r in SR.upsert_table(spark, path, new, ["day", "k"], "day").collect()}
    assert len(got) == 34 and got[("2024-01-02", 1)] == 100 and got[("2024-01-02", 77)] == 7
    assert got[("2024-01-02", 6)] == 6 and got[("None", 2)] == 2
    old = spark.read.schema(schema).parquet(path).filter(SR._one_of("day", [r[0] for r in new.select("day").distinct().collect()]))
    p = old._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in p and "2024-01-02" in p


def test_bucketed_tables_merge_without_a_shuffle(spark):
    name = f"bucketed_{uuid.uuid4().hex}"
    a = SR.write_bucketed(vectors(spark, [(u, 1, u, 0) for u in range(40)]), f"{name}_a", "user_id", 4)
    b = SR.write_bucketed(vectors(spark, [(u, 2, 2 * u, 1) for u in range(20, 60)] + [(3, 1, 99, 0)]), f"{name}_b", "user_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = SC.latest_of(a, b)
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        merged = SR.write_bucketed(out, f"{name}_c", "user_id", 4, dealt=True)
        again = SC.latest_of(merged, b)
        p = again._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in p and "SortMergeJoin" in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = {(u, 1, u, 0) for u in range(20)} | {(u, 2, 2 * u, 1) for u in range(20, 60)}
    assert {(r["user_id"], r["feature_date"].day, r["events_30d"], r["is_pro_plan"]) for r in merged.collect()} == want
    assert {(r["user_id"], r["events_30d"]) for r in again.collect()} == {(u, e) for u, _, e, _ in want}
