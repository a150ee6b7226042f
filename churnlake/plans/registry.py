"""Query registry: name -> (Spark job, DuckDB oracle SQL or None).

Each Spark job takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
test tables. Double columns are rounded alike on both sides so that the
order-insensitive value hash of the check is stable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


# Doubles are compared to so many decimals, the more the smaller they are, so that
# a wrong small p-value or index term does not round to zero on both sides.
DECIMALS = ((1.0, 6), (1e-3, 9), (0.0, 12))


def _round_sql(name: str, quote: str, suffix: str) -> str:
    """Ties away from zero in double arithmetic, the same steps in Spark and
    DuckDB, so both sides agree bit for bit; NaN and infinities pass through."""
    x = f"CAST({quote}{name}{quote} AS DOUBLE)"
    step = " ".join(f"WHEN abs({x}) >= {least!r}{suffix} THEN sign({x}) * floor(abs({x}) * {10.0 ** d!r}{suffix} + "
                    f"0.5{suffix}) / {10.0 ** d!r}{suffix}" for least, d in DECIMALS)
    return (f"CASE WHEN {x} IS NULL OR isnan({x}) OR abs({x}) = CAST('infinity' AS DOUBLE) THEN {x} {step} END"
            f" AS {quote}{name}{quote}")


def rounded(df: DataFrame) -> DataFrame:
    """Round every double column (one SQL expression each)."""
    fields = df.schema.fields
    if not any(isinstance(f.dataType, (T.DoubleType, T.FloatType)) for f in fields):
        return df
    return df.selectExpr(*[_round_sql(f.name, "`", "D") if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                           else f"`{f.name}`" for f in fields])


def with_rounded_doubles(sqls: dict[str, str], schema_dir: str) -> dict[str, str]:
    """Wrap each oracle query so that its DOUBLE columns are rounded like the
    Spark side. Column types are found by binding the query with DuckDB against
    the parquet files in ``schema_dir`` (no data is read)."""
    import os

    import duckdb

    from churnlake.sources.tables import TEST_TABLES
    if not os.path.isdir(schema_dir):
        return dict(sqls)
    con = duckdb.connect()
    for t in TEST_TABLES:
        path = f"{schema_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    out = {}
    for name, sql in sqls.items():
        desc = con.execute(f"DESCRIBE SELECT * FROM ({sql}) AS q").fetchall()
        dbl = [r[0] for r in desc if str(r[1]).upper() in ("DOUBLE", "FLOAT", "REAL")]
        if not dbl:
            out[name] = sql
            continue
        repl = ", ".join(_round_sql(c, '"', "") for c in dbl)
        out[name] = f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS q"
    con.close()
    return out


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from churnlake.plans import (  # noqa: F401
        q_abtest,
        q_features,
        q_monitoring,
        q_registry,
        q_scoring,
        q_sources,
        q_streaming,
        q_time,
        q_validation,
    )
