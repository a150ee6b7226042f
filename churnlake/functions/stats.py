"""Statistics as Spark column expressions, plus one vectorised UDF.

* ``normal_cdf``: Abramowitz-Stegun 7.1.26 erf (|error| < 1.5e-7), JVM-side.
* ``kolmogorov_pvalue``: asymptotic Kolmogorov distribution with Stephens'
  small-sample correction, a 100-term alternating series built with ``aggregate``.
* ``running_totals``: exact distributed prefix sums per group over a sorted value
  (the building block of KS, AUC and PSI). Rows are range-partitioned on (group,
  value); offsets are summed over the partitions' totals and the running sum runs
  inside each (group, partition), so no task ever receives a whole group.
* ``exact_quantiles``: exact linear-interpolation quantiles per group from the
  same prefix sums (no task holds a group's values).
* ``t_two_sided_pvalue``: Student-t two-sided p-value through the regularised
  incomplete beta function (NumPy continued fraction) as a pandas UDF; it runs
  on one row per test.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.sources.store import stored

# Abramowitz & Stegun 7.1.26 coefficients.
AS_P = 0.3275911
AS_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erf(x: Column) -> Column:
    ax = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(AS_P) * ax)
    poly = t * (F.lit(AS_A[0]) + t * (F.lit(AS_A[1]) + t * (F.lit(AS_A[2]) + t * (F.lit(AS_A[3]) + t * F.lit(AS_A[4])))))
    y = F.lit(1.0) - poly * F.exp(-ax * ax)
    return F.when(x < 0, -y).otherwise(y)


def normal_cdf(x: Column, mean: Column, std: Column) -> Column:
    z = F.try_divide(x - mean, std * F.lit(math.sqrt(2.0)))  # degenerate std -> null
    return F.lit(0.5) * (F.lit(1.0) + erf(z))


def erf_sql(x: str) -> str:
    """The same approximation as DuckDB / Spark SQL text (for the oracle)."""
    t = f"(1.0 / (1.0 + {AS_P} * abs({x})))"
    poly = f"({t} * ({AS_A[0]} + {t} * ({AS_A[1]} + {t} * ({AS_A[2]} + {t} * ({AS_A[3]} + {t} * {AS_A[4]})))))"
    y = f"(1.0 - {poly} * exp(-abs({x}) * abs({x})))"
    return f"(CASE WHEN {x} < 0 THEN -{y} ELSE {y} END)"


def normal_cdf_sql(x: str, mean: str, std: str) -> str:
    return f"(0.5 * (1.0 + {erf_sql(f'(({x}) - ({mean})) / (({std}) * {math.sqrt(2.0)})')}))"


KS_TERMS = 100


def kolmogorov_pvalue(d: Column, n_eff: Column) -> Column:
    """P(D > d) for the KS statistic ``d`` with effective sample size ``n_eff``."""
    sn = F.sqrt(n_eff)
    lam = (sn + F.lit(0.12) + F.lit(0.11) / sn) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)), F.lit(0.0),
        lambda acc, j: acc + F.lit(2.0) * F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(F.lit(-2.0) * j * j * lam * lam))
    p = F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0))
    return F.when(n_eff <= 0, None).when(lam < 0.3, F.lit(1.0)).otherwise(p)


def kolmogorov_pvalue_sql(d: str, n_eff: str) -> str:
    lam = f"((sqrt({n_eff}) + 0.12 + 0.11 / sqrt({n_eff})) * ({d}))"
    series = (f"list_sum([2.0 * (CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * j * j * {lam} * {lam}) "
              f"FOR j IN range(1, {KS_TERMS + 1})])")
    return (f"(CASE WHEN {n_eff} <= 0 THEN NULL WHEN {lam} < 0.3 THEN 1.0 "
            f"ELSE least(greatest({series}, 0.0), 1.0) END)")


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str], spread: str) -> DataFrame:
    """Join the one row per group of ``stats`` (without keys: its one row) to the
    rows of ``df``. The rows of a group are dealt by a hash of ``spread`` over as
    many salts as there are shuffle partitions, and ``stats`` is repeated for each
    salt: a group is never one task, whichever join the planner picks, and there
    is no constant key that the optimizer could fold into a nested loop."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    salted = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return (df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(n)).cast("int"))
            .join(salted, [*keys, "_salt"]).drop("_salt"))


def running_totals(df: DataFrame, keys: Sequence[str], value: str | Sequence[str], sums: Sequence[str],
                   buckets: int | None = None) -> DataFrame:
    """Add ``cum_<s>`` = sum of ``s`` over rows of the same group with value <= this one.

    ``df`` must be unique on ``keys + value`` (aggregate first); of rows that are
    not, each counts those before it in some order. Rows are dealt by
    ``repartitionByRange(keys, value)``, so a large group lies in many partitions
    and small ones share one. The dealt rows are stored once, since the range
    bounds come from a sample and the two readings below must see the same ones.
    Each partition's totals of a group (as many rows as partitions, plus one a
    group) give the offsets; the running sum runs inside (group, partition).
    No row looks at the bounds, and no task receives a whole group. The number of
    partitions (``buckets``, by default the session's) changes no result.
    """
    keys, order = list(keys), [value] if isinstance(value, str) else list(value)
    n = buckets or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    dealt = stored(df.repartitionByRange(n, *keys, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    tot = dealt.groupBy(*keys, "_part").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    # without keys there is one row per partition
    wb = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*keys, "_part", *[F.coalesce(F.sum(f"_t_{s}").over(wb), F.lit(0)).alias(f"_o_{s}") for s in sums])
    wv = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = dealt.join(off, [*keys, "_part"])
    for s in sums:
        out = out.withColumn(f"cum_{s}", F.sum(s).over(wv) + F.col(f"_o_{s}"))
    return out.drop("_part", *[f"_o_{s}" for s in sums])


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                    buckets: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (as ``percentile`` /
    ``quantile_cont``) per group, one column ``q<i>`` per probability.

    Built on ``running_totals`` over the distinct values, so no task holds a
    group's values: the value at 0-based rank i is the smallest value whose
    cumulative count exceeds i, found with a filtered ``min`` (map-side combined).
    """
    keys = list(keys)
    x = F.col(value).cast("double")
    counts = df.filter(x.isNotNull()).groupBy(*keys, x.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    cum = running_totals(counts, keys, "_v", ["_c"], buckets)
    n = counts.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    j = attach(cum, n, keys, "_v")
    aggs = []
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1) * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs += [F.min(F.when(F.col("cum__c") > lo, F.col("_v"))).alias(f"_lo{i}"),
                 F.min(F.when(F.col("cum__c") > hi, F.col("_v"))).alias(f"_hi{i}"),
                 F.first(pos - lo).alias(f"_fr{i}")]
    agg = j.groupBy(*keys).agg(*aggs)
    return agg.select(*keys, *[(F.col(f"_lo{i}") + F.col(f"_fr{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}")))
                               .alias(f"q{i}") for i in range(len(probs))])


# --- Student t ---------------------------------------------------------------

def _betacf(a: np.ndarray, b: np.ndarray, x: np.ndarray, iters: int = 300, eps: float = 3e-16) -> np.ndarray:
    """Continued fraction of the incomplete beta (modified Lentz), vectorised."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < tiny, tiny, d)
    d = 1.0 / d
    h = d.copy()
    for m in range(1, iters + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < tiny, tiny, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        d = 1.0 / d
        h = h * d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < tiny, tiny, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        d = 1.0 / d
        delta = d * c
        h = h * delta
        if np.all(np.abs(delta - 1.0) < eps):
            break
    return h


def betainc(a, b, x) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b), vectorised over arrays."""
    a, b, x = (np.asarray(v, dtype=float) for v in (a, b, x))
    a, b, x = np.broadcast_arrays(a, b, x)
    out = np.full(x.shape, np.nan)
    ok = (x >= 0) & (x <= 1) & (a > 0) & (b > 0)
    lg = np.vectorize(math.lgamma, otypes=[float])
    with np.errstate(all="ignore"):
        lbt = lg(a + b) - lg(a) - lg(b) + a * np.log(np.where(x > 0, x, 1.0)) + b * np.log(np.where(x < 1, 1.0 - x, 1.0))
        bt = np.where((x == 0) | (x == 1), 0.0, np.exp(lbt))
        front = x < (a + 1.0) / (a + b + 2.0)
        direct = bt * _betacf(a, b, x) / a
        mirror = 1.0 - bt * _betacf(b, a, 1.0 - x) / b
    res = np.where(front, direct, mirror)
    out[ok] = res[ok]
    return out


def t_two_sided_pvalue_np(t, dof) -> np.ndarray:
    """2 * (1 - T_dof(|t|)) = I_{dof / (dof + t^2)}(dof / 2, 1 / 2)."""
    t = np.asarray(t, dtype=float)
    dof = np.asarray(dof, dtype=float)
    with np.errstate(all="ignore"):
        x = dof / (dof + t * t)
    return betainc(dof / 2.0, 0.5, x)


@F.pandas_udf(T.DoubleType())
def t_two_sided_pvalue(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(t_two_sided_pvalue_np(t.to_numpy(dtype=float, na_value=np.nan),
                                           dof.to_numpy(dtype=float, na_value=np.nan)))


def t_two_sided_pvalue_sql(t: str, dof: str, panels: int = 20000) -> str:
    """DuckDB text of the same p-value by Simpson integration of the t density
    over [0, |t|] (used only by the oracle, as an independent check)."""
    nu = f"({dof})"
    h = f"(abs({t}) / {panels})"
    x = f"(r.i * {h})"
    logc = f"(lgamma(({nu} + 1) / 2.0) - lgamma({nu} / 2.0) - 0.5 * ln({nu} * pi()))"
    dens = f"exp({logc} - ({nu} + 1) / 2.0 * ln(1 + {x} * {x} / {nu}))"
    weight = f"(CASE WHEN r.i = 0 OR r.i = {panels} THEN 1 WHEN r.i % 2 = 1 THEN 4 ELSE 2 END)"
    integral = f"(SELECT sum({weight} * {dens}) * {h} / 3.0 FROM range(0, {panels + 1}) r(i))"
    return f"greatest(least(1.0 - 2.0 * {integral}, 1.0), 0.0)"
