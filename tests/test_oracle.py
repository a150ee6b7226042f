"""Registered queries vs their DuckDB oracle on the sf0.001 tables.

A representative key per operator family runs by default; set
CHURNLAKE_FULL_ORACLE=1 to run every registered key."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from churnlake.sources.tables import TEST_TABLES

SF = "/root/testdata/sf0.001"
DEFAULT = ["feature_snapshot", "feature_snapshot_b", "training_dataset", "training_dataset_daily", "custom_feature_spec",
           "label_churned_30d", "load_users_ignore", "domain_violations", "store_rewrite_partition", "validation_report",
           "feature_describe", "pit_leakage_audit", "hourly_metrics", "metrics_upsert", "drift_flags", "ks_two_sample",
           "psi", "drift_log", "alerts", "outcome_backfill", "score_batch", "explain_contributions", "eval_auc",
           "threshold_analysis", "ab_assign", "ab_welch", "ab_winner_normal", "promotion_audit", "retraining_signals",
           "sessionize", "stream_hourly_metrics", "stream_sessions"]
ORACLE = E.oracle_sql()
KEYS = sorted(ORACLE) if os.environ.get("CHURNLAKE_FULL_ORACLE") else DEFAULT


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=lambda t: tuple(str(x) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TEST_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_contract(spark):
    qs = E.queries()
    assert set(ORACLE) <= set(qs)
    assert E.entry(spark).count() > 0


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[key])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, got) == _rows(cols, cur.fetchall())
    duck = {r[0]: str(r[1]) for r in con.execute(f"DESCRIBE SELECT * FROM ({ORACLE[key]}) q").fetchall()}
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == duck
