"""Typed reads of the test tables and their projection into the churn domain.

``/root/testdata`` holds TPC-H-like tables plus an ``events`` stream; the churn
jobs need users / user_events / billing_events. Two deterministic projections
are defined here (and mirrored as SQL text in ``plans/oracle_sql.py``):

* mapping A, a dense January 2024 built from ``events``;
* mapping B, a long 1995-2001 horizon built from ``orders`` and ``lineitem``.

Reads select columns explicitly so that the parquet scan is pruned, and all
filters are plain column predicates so that Catalyst pushes them to the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.sources import schemas as S

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _schema(ddl: str):
    from pyspark.sql.types import _parse_datatype_string
    return _parse_datatype_string(ddl)


# Declared schemas of the source tables this library reads: the planner then
# never opens file footers to infer them (one listing per read, no sampling).
SOURCE_DDL = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    ddl = SOURCE_DDL.get(name)
    return spark.read.schema(_schema(ddl)).parquet(path) if ddl else spark.read.parquet(path)


@dataclass(frozen=True)
class Domain:
    """The three raw churn tables of one projection."""

    users: DataFrame
    user_events: DataFrame
    billing_events: DataFrame


def _users(spark: SparkSession, sf_dir: str, signup_origin: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation is a fixed 25-row dimension; the planner broadcasts it from its size estimate.
    return (customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
            .selectExpr("CAST(c_custkey AS BIGINT) AS user_id",
                        "CASE WHEN c_mktsegment = 'BUILDING' THEN 'pro' "
                        "WHEN c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN 'basic' ELSE 'free' END AS plan_type",
                        f"TIMESTAMP_NTZ'{signup_origin} 00:00:00' - make_dt_interval(CAST(c_custkey % 365 AS INT))"
                        " AS signup_date",
                        "n_name AS country"))


def valid_billing(billing: DataFrame) -> DataFrame:
    """The domain rule of the billing table: an amount, and not a negative one."""
    return billing.filter("amount >= 0")


def mapping_a(spark: SparkSession, sf_dir: str, checked: bool = True) -> Domain:
    """Dense month: January 2024 from ``events``. ``checked=False`` keeps billing
    rows that break the domain rule (for the audit)."""
    users = _users(spark, sf_dir, "2024-01-15")
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "value", "props")
    user_events = (ev.filter("event_type NOT IN ('purchase', 'error')")
                   .selectExpr("CAST(user_id AS BIGINT) AS user_id",
                               "CASE event_type WHEN 'signup' THEN 'login' WHEN 'view' THEN 'page_view' "
                               "WHEN 'click' THEN 'search' ELSE event_type END AS event_type",
                               "ts AS event_time",
                               "concat(CAST(user_id AS STRING), '-', CAST(to_date(ts) AS STRING)) AS session_id"))
    billing = (ev.filter("event_type IN ('purchase', 'error')")
               .selectExpr("CAST(user_id AS BIGINT) AS user_id", "value AS amount",
                           "CASE WHEN event_type = 'error' THEN 'failed' "
                           "WHEN try_cast(get_json_object(props, '$.k') AS INT) < 5 THEN 'refunded' "
                           "ELSE 'successful' END AS status",
                           "ts AS event_time"))
    return Domain(users, user_events, valid_billing(billing) if checked else billing)


def mapping_b(spark: SparkSession, sf_dir: str, checked: bool = True) -> Domain:
    """Long horizon 1995-2001: line items are activity, orders are billing.
    ``checked`` as in ``mapping_a``."""
    users = _users(spark, sf_dir, "1995-01-01")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                        "o_totalprice", "o_orderdate")
    lineitem = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    user_events = (lineitem.join(orders.select("o_orderkey", "o_custkey"),
                                 lineitem.l_orderkey == orders.o_orderkey, "inner")
                   .selectExpr("CAST(o_custkey AS BIGINT) AS user_id",
                               "CASE WHEN l_linenumber = 1 THEN 'login' ELSE 'page_view' END AS event_type",
                               "l_shipdate AS event_time", "CAST(l_orderkey AS STRING) AS session_id"))
    billing = orders.selectExpr("CAST(o_custkey AS BIGINT) AS user_id", "o_totalprice AS amount",
                                "CASE o_orderstatus WHEN 'F' THEN 'successful' WHEN 'O' THEN 'failed' "
                                "WHEN 'P' THEN 'refunded' END AS status",
                                "o_orderdate AS event_time")
    return Domain(users, user_events, valid_billing(billing) if checked else billing)


def typed(df: DataFrame, schema) -> DataFrame:
    """Project a frame onto a schema (names + types), dropping anything else."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def src_users(d: Domain) -> DataFrame:
    return typed(d.users, S.USERS)


def src_user_events(d: Domain) -> DataFrame:
    return typed(d.user_events, S.USER_EVENTS)


def src_billing_events(d: Domain) -> DataFrame:
    return typed(d.billing_events, S.BILLING_EVENTS)
