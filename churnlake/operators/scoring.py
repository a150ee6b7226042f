"""Scoring, explanation and the latest-vector store.

A model is a standardiser (per-feature mean / std, fitted like
``pyspark.ml.feature.StandardScaler`` with the corrected sample std) plus a
logistic layer (intercept + one weight per feature). Scoring is one column
expression over a left join of the requested ids with the latest vectors, so it
stays inside whole-stage codegen; only the fitted parameters (two numbers per
feature) ever reach the driver, exactly as ``StandardScaler.fit`` does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.functions.timefn import ts
from churnlake.sources import schemas as S

THRESHOLD = 0.5
CACHE_TTL_HOURS = 24

# The logistic weights of the scoring model used by the registered
# jobs (standardised inputs, catalogue column order).
FIXED_WEIGHTS = {
    "avg_sessions_7d": -0.8,
    "sessions_30d": -0.5,
    "days_since_last_login": 1.2,
    "events_30d": -0.6,
    "failed_payments_30d": 0.7,
    "total_spend_90d": -0.3,
    "refunds_30d": 0.4,
    "is_pro_plan": -0.2,
    "is_paid_plan": -0.4,
    "days_since_signup": -0.1,
}
FIXED_INTERCEPT = -1.5


@dataclass(frozen=True)
class Scaler:
    mean: Mapping[str, float]
    std: Mapping[str, float]

    def column(self, name: str, x: Column | None = None) -> Column:
        x = F.col(name) if x is None else x
        s = self.std.get(name)
        if not s:  # zero or missing variance: centre only (StandardScaler leaves 0)
            return F.lit(0.0)
        return (x.cast("double") - F.lit(float(self.mean[name]))) / F.lit(float(s))


def scaling_stats(train: DataFrame, features: Sequence[str] = S.FEATURE_COLUMNS) -> DataFrame:
    """(feature_name, mean, std) of the training rows: one global aggregate."""
    agg = train.agg(*[F.avg(F.col(c).cast("double")).alias(f"{c}__mean") for c in features],
                    *[F.stddev_samp(F.col(c).cast("double")).alias(f"{c}__std") for c in features])
    stack = ", ".join(f"'{c}', `{c}__mean`, `{c}__std`" for c in features)
    return agg.selectExpr(f"stack({len(features)}, {stack}) AS (feature_name, mean, std)")


def fit_scaler(train: DataFrame, features: Sequence[str] = S.FEATURE_COLUMNS) -> Scaler:
    """Fit the standardiser; the result is 2 x len(features) numbers."""
    rows = scaling_stats(train, features).collect()
    return Scaler({r["feature_name"]: r["mean"] for r in rows}, {r["feature_name"]: r["std"] for r in rows})


@dataclass(frozen=True)
class LogisticModel:
    scaler: Scaler
    weights: Mapping[str, float] = field(default_factory=lambda: dict(FIXED_WEIGHTS))
    intercept: float = FIXED_INTERCEPT
    threshold: float = THRESHOLD

    @property
    def features(self) -> tuple[str, ...]:
        return tuple(self.weights)

    def margin(self, raw: bool = False) -> Column:
        """b + sum w * x; absent features count as 0.0 (in scaled space unless raw)."""
        terms = [F.lit(float(self.intercept))]
        for f, w in self.weights.items():
            x = F.coalesce(F.col(f).cast("double"), F.lit(0.0))
            v = x if raw else self.scaler.column(f, x)
            terms.append(F.lit(float(w)) * v)
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return out

    def probability(self, raw: bool = False) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin(raw)))


def scale_features(df: DataFrame, scaler: Scaler, features: Sequence[str] = S.FEATURE_COLUMNS) -> DataFrame:
    keep = [c for c in df.columns if c not in features]
    return df.select(*keep, *[scaler.column(c).alias(c) for c in features])


def latest_features(store: DataFrame) -> DataFrame:
    """Newest vector per user (offline -> online sync): each column is picked by the
    latest snapshot date in one hash aggregate, with a partial step per task before
    the shuffle (no window over a user's rows, no sort). Needs one row per user and
    date."""
    cols = [c for c in store.columns if c not in ("user_id", "feature_date")]
    got = store.groupBy("user_id").agg(F.max("feature_date").alias("feature_date"),
                                       *[F.max_by(c, "feature_date").alias(c) for c in cols])
    return got.select(*store.columns)


def latest_of(current: DataFrame, new: DataFrame) -> DataFrame:
    """Merge of two tables of one vector per user: the newer one stays, ``current``
    on equal dates. A full join on the user, which bucketed tables answer without a
    shuffle (``store.write_bucketed``)."""
    cols = [c for c in current.columns if c != "user_id"]
    a = current.select("user_id", F.struct(*cols).alias("_a"))
    b = new.select("user_id", F.struct(*[F.col(c) for c in cols]).alias("_b"))
    newer = F.col("_a").isNull() | (F.col("_b.feature_date") > F.col("_a.feature_date"))
    pick = F.when(newer, F.col("_b")).otherwise(F.col("_a")).alias("_v")
    return a.join(b, "user_id", "full").select("user_id", pick).select(
        "user_id", *[F.col(f"_v.{c}").alias(c) for c in cols]).select(*current.columns)


def sync_latest(store: DataFrame, snapshot_date, current: DataFrame | None = None) -> DataFrame:
    """Offline -> online sync for one snapshot date (the date is a parameter,
    never the clock). The snapshot partition is read with a partition filter;
    an empty snapshot is an error rather than a silent no-op. With ``current``
    (the latest table so far) newer vectors replace older ones per user."""
    from churnlake.sources.store import snapshot_for_date

    snap = snapshot_for_date(store, snapshot_date)
    if snap.isEmpty():  # one row probed, not a count
        raise ValueError(f"no feature snapshot for {snapshot_date}")
    return latest_features(snap if current is None else current.unionByName(snap))


def model_of(pipeline_model, threshold: float = THRESHOLD) -> LogisticModel:
    """A fitted pipeline (assembler, standardiser, logistic regression; see
    ``evaluate.fit_logistic``) as the model that scoring and explanation use: its
    scaler and coefficients become one column expression over the vectors, so
    scoring needs no assembled vectors and no pass over them by the pipeline."""
    asm, scl, lr = pipeline_model.stages
    names = asm.getInputCols()
    scaler = Scaler({f: float(m) for f, m in zip(names, scl.mean)}, {f: float(x) for f, x in zip(names, scl.std)})
    return LogisticModel(scaler, {f: float(w) for f, w in zip(names, lr.coefficients)}, float(lr.intercept), threshold)


def score_batch(requests: DataFrame, vectors: DataFrame, model: LogisticModel) -> DataFrame:
    """Requested ids -> probability, label and status; ids without a vector
    get an error row (status ``no_features``)."""
    j = requests.select("user_id").join(vectors, "user_id", "left")
    found = F.col("feature_date").isNotNull()
    p = model.probability()
    return j.select("user_id",
                    F.when(found, p).alias("churn_probability"),
                    F.when(found, (p >= model.threshold).cast("int")).alias("predicted_label"),
                    F.when(found, "ok").otherwise("no_features").alias("status"),
                    F.col("feature_date").alias("vector_date"))


def explain_contributions(vectors: DataFrame, model: LogisticModel, raw: bool = False,
                          top: int | None = None) -> DataFrame:
    """Per user and feature: value, scaled value, coefficient, contribution and its
    rank by absolute size (ties by feature name); the intercept is a column."""
    feats = model.features
    parts = []
    for f in feats:
        x = F.coalesce(F.col(f).cast("double"), F.lit(0.0))
        v = x if raw else model.scaler.column(f, x)
        parts += [F.lit(f), x, v, F.lit(float(model.weights[f]))]
    long = vectors.select("user_id", F.inline(F.array(*[
        F.struct(parts[i].alias("feature_name"), parts[i + 1].alias("value"), parts[i + 2].alias("scaled_value"),
                 parts[i + 3].alias("coefficient")) for i in range(0, len(parts), 4)])))
    long = long.withColumn("contribution", F.col("scaled_value") * F.col("coefficient"))
    # at most len(features) rows per user: a bounded window
    w = Window.partitionBy("user_id").orderBy(F.abs("contribution").desc(), "feature_name")
    out = (long.withColumn("rank", F.row_number().over(w))
           .withColumn("intercept", F.lit(float(model.intercept))))
    return out.filter(F.col("rank") <= top) if top else out


# --- latest-vector cache (key / JSON value / sync time) --------------------------

def cache_key(user_id: Column) -> Column:
    return F.concat(F.lit("user:"), user_id.cast("string"), F.lit(":features"))


def features_to_json(vectors: DataFrame, synced_at: Column,
                     features: Sequence[str] = S.FEATURE_COLUMNS) -> DataFrame:
    """(user_id, cache_key, features JSON, synced_at)."""
    return vectors.select("user_id", cache_key(F.col("user_id")).alias("cache_key"),
                          F.to_json(F.struct(*[F.col(c) for c in features])).alias("features"),
                          synced_at.alias("synced_at"))


def json_schema(template: DataFrame, features: Sequence[str] = S.FEATURE_COLUMNS) -> T.StructType:
    return T.StructType([T.StructField(c, template.schema[c].dataType) for c in features])


def features_from_json(cache: DataFrame, schema: T.StructType) -> DataFrame:
    """Parse cached JSON; malformed values become nulls and the row is kept."""
    parsed = F.from_json(F.col("features"), schema, {"mode": "PERMISSIVE"})
    return cache.select("user_id", "cache_key", *[parsed[f.name].alias(f.name) for f in schema.fields])


def lookup_batch(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Many keys at once; the JSON is null where the key is absent."""
    return (requests.select("user_id").join(cache.select("user_id", "features", "synced_at"), "user_id", "left")
            .select("user_id", cache_key(F.col("user_id")).alias("cache_key"), "features", "synced_at"))


def unexpired(cache: DataFrame, as_of, ttl_hours: int = CACHE_TTL_HOURS) -> DataFrame:
    now = ts(as_of)
    return cache.filter(now < F.col("synced_at") + F.make_dt_interval(F.lit(0), F.lit(ttl_hours)))


def cache_stats(cache: DataFrame, as_of, ttl_hours: int = CACHE_TTL_HOURS) -> DataFrame:
    now = ts(as_of)
    alive = now < F.col("synced_at") + F.make_dt_interval(F.lit(0), F.lit(ttl_hours))
    return cache.agg(F.count_distinct("user_id").alias("users_cached"),
                     F.count(F.lit(1)).alias("keys"),
                     F.count_if(alive).alias("keys_unexpired"))
