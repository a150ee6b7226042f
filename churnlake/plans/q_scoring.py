"""Registered scoring, explanation, latest-vector and evaluation queries
(SURVEY §2.D, §2.E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.functions.timefn import ts
from churnlake.operators import evaluate as EV
from churnlake.operators import features as FE
from churnlake.operators import scoring as SC
from churnlake.plans import oracle_sql as O
from churnlake.plans.q_features import (
    STORE_N_A,
    STORE_START_A,
    STORE_STEP_A,
    TRAIN_N_B,
    TRAIN_START_B,
    TRAIN_STEP_B,
)
from churnlake.plans.registry import register
from churnlake.session import scratch_path
from churnlake.sources import schemas as S
from churnlake.sources.predictions import training_baseline_frame
from churnlake.sources.store import stored
from churnlake.sources.tables import mapping_a, mapping_b

FEATS = S.FEATURE_COLUMNS
CACHE_AS_OF = "2024-01-30 00:00:00"
ONE_USER = 7

# --- Spark fixtures ---------------------------------------------------------------


def active_store(spark, sf_dir):
    """Weekly snapshots for users with any activity (the synced population)."""
    d = mapping_a(spark, sf_dir)
    active = d.user_events.select("user_id").distinct()
    # the population is most users: restrict the (small) aggregated grid, not the fact tables
    grid = FE.feature_grid(d, FE.make_grid(STORE_START_A, STORE_N_A, STORE_STEP_A))
    return grid.join(active, "user_id", "left_semi")


def model(spark, sf_dir) -> SC.LogisticModel:
    """The scoring model: fixed weights over the standardiser fitted on the
    training rows (20 numbers). Fitted for each query: the fit is part of its work."""
    return SC.LogisticModel(SC.fit_scaler(training_baseline_frame(spark, sf_dir)))


def latest(spark, sf_dir):
    return SC.latest_features(active_store(spark, sf_dir))


def requests(spark, sf_dir):
    return mapping_a(spark, sf_dir).users.select("user_id")


def cache(spark, sf_dir):
    """Latest vectors as JSON, synced at the snapshot date + (user_id % 48) hours."""
    v = latest(spark, sf_dir)
    synced = F.col("feature_date") + F.make_dt_interval(F.lit(0), (F.col("user_id") % 48).cast("int"))
    return SC.features_to_json(v, synced)


# --- SQL fixtures -------------------------------------------------------------------

_STORE = O.grid_sql("A", STORE_START_A, STORE_N_A, STORE_STEP_A, prefix="st_",
                    user_filter="u.user_id IN (SELECT user_id FROM user_events)")
_BASE = O.grid_sql("A", "2024-01-03", 3, 7, prefix="bz_", with_mapping=False)
_STATS = ("stats AS (SELECT " + ", ".join(
    f"avg(CAST({c} AS DOUBLE)) AS {c}_m, stddev_samp(CAST({c} AS DOUBLE)) AS {c}_s" for c in FEATS) + " FROM bz_snap)")
FIX_SQL = f"""{_STORE},
{_BASE},
{_STATS},
latest AS (SELECT * FROM st_snap QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY feature_date DESC) = 1)"""


def _z(c: str, src: str = "v") -> str:
    return (f"(CASE WHEN stats.{c}_s > 0 THEN (coalesce(CAST({src}.{c} AS DOUBLE), 0.0) - stats.{c}_m) / stats.{c}_s"
            f" ELSE 0.0 END)")


_MARGIN = f"({SC.FIXED_INTERCEPT}" + "".join(f" + {SC.FIXED_WEIGHTS[c]} * {_z(c)}" for c in FEATS) + ")"
_PROB = f"(1.0 / (1.0 + exp(-{_MARGIN})))"

_SCORE_SQL = FIX_SQL + f""",
scored AS (
  SELECT u.user_id,
         CASE WHEN v.feature_date IS NOT NULL THEN {_PROB} END AS churn_probability,
         CASE WHEN v.feature_date IS NOT NULL THEN CAST({_PROB} >= 0.5 AS INTEGER) END AS predicted_label,
         CASE WHEN v.feature_date IS NOT NULL THEN 'ok' ELSE 'no_features' END AS status,
         v.feature_date AS vector_date
  FROM users u LEFT JOIN latest v ON v.user_id = u.user_id, stats)"""


def scored(spark, sf_dir):
    return SC.score_batch(requests(spark, sf_dir), latest(spark, sf_dir), model(spark, sf_dir))


@register("score_batch", _SCORE_SQL + "\nSELECT * FROM scored")
def q_score_batch(spark, sf_dir):
    """Every user scored from the latest synced vector; error rows without one."""
    return scored(spark, sf_dir)


@register("score_one", _SCORE_SQL + f"\nSELECT * FROM scored WHERE user_id = {ONE_USER}")
def q_score_one(spark, sf_dir):
    """Single-user prediction: the batch plan with one requested id."""
    req = requests(spark, sf_dir).filter(F.col("user_id") == ONE_USER)
    return SC.score_batch(req, latest(spark, sf_dir), model(spark, sf_dir))


@register("latest_features", FIX_SQL + "\nSELECT * FROM latest")
def q_latest_features(spark, sf_dir):
    return latest(spark, sf_dir)


def _explain_ctes() -> str:
    rows = "\n  UNION ALL ".join(
        f"SELECT v.user_id, '{c}' AS feature_name, coalesce(CAST(v.{c} AS DOUBLE), 0.0) AS value, {_z(c)} AS scaled_value, "
        f"CAST({SC.FIXED_WEIGHTS[c]} AS DOUBLE) AS coefficient FROM latest v, stats" for c in FEATS)
    return FIX_SQL + f""",
ex AS ({rows}),
ranked AS (SELECT *, scaled_value * coefficient AS contribution FROM ex)"""


def contributions(spark, sf_dir):
    return SC.explain_contributions(latest(spark, sf_dir), model(spark, sf_dir))


@register("explain_contributions", _explain_ctes() + f"""
SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY abs(contribution) DESC, feature_name) AS rank,
       CAST({SC.FIXED_INTERCEPT} AS DOUBLE) AS intercept FROM ranked""")
def q_explain_contributions(spark, sf_dir):
    return contributions(spark, sf_dir).withColumn("rank", F.col("rank").cast("long"))


@register("feature_importance", _explain_ctes() + """
SELECT feature_name, avg(abs(contribution)) AS mean_abs_contribution FROM ranked
GROUP BY feature_name ORDER BY mean_abs_contribution DESC, feature_name LIMIT 5""")
def q_feature_importance(spark, sf_dir):
    """Top-5 features by mean |contribution| over all scored users."""
    return EV.feature_importance(contributions(spark, sf_dir), 5)


_CACHE_SQL = FIX_SQL + """,
cache AS (SELECT user_id, concat('user:', CAST(user_id AS VARCHAR), ':features') AS cache_key, latest.*,
                 feature_date + to_hours(CAST(user_id % 48 AS INTEGER)) AS synced_at FROM latest)"""
_VEC_COLS = ", ".join(f"{c}" for c in FEATS)


@register("features_to_json", _CACHE_SQL + f"\nSELECT user_id, cache_key, {_VEC_COLS} FROM cache")
def q_features_to_json(spark, sf_dir):
    """Vectors written as JSON under ``user:{id}:features`` and parsed back."""
    c = cache(spark, sf_dir)
    return SC.features_from_json(c, SC.json_schema(latest(spark, sf_dir)))


@register("features_from_json", """
SELECT CAST(event_id AS BIGINT) AS event_id,
       TRY_CAST(json_extract_string(props, '$.avg_sessions_7d') AS DOUBLE) AS avg_sessions_7d,
       TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events""")
def q_features_from_json(spark, sf_dir):
    """Parse foreign JSON (the events' props) with a vector schema: absent keys
    become nulls and every row is kept."""
    from pyspark.sql import types as T

    from churnlake.sources.tables import read_table
    id_ = F.col("event_id").cast("long")
    ev = read_table(spark, sf_dir, "events").select(id_.alias("user_id"), SC.cache_key(id_).alias("cache_key"),
                                                     F.col("props").alias("features"))
    schema = T.StructType([T.StructField("avg_sessions_7d", T.DoubleType()), T.StructField("k", T.LongType())])
    return SC.features_from_json(ev, schema).select(F.col("user_id").alias("event_id"), "avg_sessions_7d", "k")


@register("lookup_batch", _CACHE_SQL + """
SELECT u.user_id, concat('user:', CAST(u.user_id AS VARCHAR), ':features') AS cache_key,
       c.avg_sessions_7d IS NOT NULL AS hit, c.synced_at
FROM users u LEFT JOIN cache c ON c.user_id = u.user_id""")
def q_lookup_batch(spark, sf_dir):
    """Every user looked up at once; misses are null."""
    r = SC.lookup_batch(requests(spark, sf_dir), cache(spark, sf_dir))
    return r.select("user_id", "cache_key", F.col("features").isNotNull().alias("hit"), "synced_at")


@register("unexpired_features", _CACHE_SQL + f"""
SELECT user_id, cache_key, synced_at FROM cache
WHERE TIMESTAMP '{CACHE_AS_OF}' < synced_at + INTERVAL 24 HOUR""")
def q_unexpired_features(spark, sf_dir):
    return SC.unexpired(cache(spark, sf_dir), CACHE_AS_OF).select("user_id", "cache_key", "synced_at")


@register("cache_stats", _CACHE_SQL + f"""
SELECT count(DISTINCT user_id) AS users_cached, count(*) AS keys,
       count(*) FILTER (WHERE TIMESTAMP '{CACHE_AS_OF}' < synced_at + INTERVAL 24 HOUR) AS keys_unexpired
FROM cache""")
def q_cache_stats(spark, sf_dir):
    return SC.cache_stats(cache(spark, sf_dir), CACHE_AS_OF)


_DEFAULTS_SQL = FIX_SQL + """
SELECT u.user_id, v.feature_date IS NULL AS is_default,
       coalesce(v.avg_sessions_7d, 0.0) AS avg_sessions_7d, CAST(coalesce(v.sessions_30d, 0) AS BIGINT) AS sessions_30d,
       CAST(coalesce(v.days_since_last_login, 9999) AS INTEGER) AS days_since_last_login,
       CAST(coalesce(v.events_30d, 0) AS BIGINT) AS events_30d,
       CAST(coalesce(v.failed_payments_30d, 0) AS BIGINT) AS failed_payments_30d,
       coalesce(v.total_spend_90d, 0.0) AS total_spend_90d, CAST(coalesce(v.refunds_30d, 0) AS BIGINT) AS refunds_30d,
       CAST(coalesce(v.is_pro_plan, 0) AS INTEGER) AS is_pro_plan, CAST(coalesce(v.is_paid_plan, 0) AS INTEGER) AS is_paid_plan,
       CAST(coalesce(v.days_since_signup, 0) AS INTEGER) AS days_since_signup
FROM users u LEFT JOIN latest v ON v.user_id = u.user_id"""


@register("default_features", _DEFAULTS_SQL)
def q_default_features(spark, sf_dir):
    """Users without a synced vector get safe defaults (0, last login 9999)."""
    return FE.default_features(requests(spark, sf_dir), latest(spark, sf_dir))


# --- training / evaluation on mapping B ------------------------------------------------

_TRAIN_SQL = O.grid_sql("B", TRAIN_START_B, TRAIN_N_B, TRAIN_STEP_B, with_label=True, existing_only=True)


def training(spark, sf_dir):
    return FE.training_dataset(mapping_b(spark, sf_dir), TRAIN_START_B, TRAIN_N_B, TRAIN_STEP_B)


@register("training_matrix", _TRAIN_SQL + """
SELECT * FROM snap WHERE feature_date >= TIMESTAMP '1998-01-12' AND feature_date < TIMESTAMP '1998-03-16'""")
def q_training_matrix(spark, sf_dir):
    """Features joined to labels on (user, date) within a date range."""
    t = training(spark, sf_dir)
    feats, labels = FE.split_features_labels(t)
    return EV.training_matrix(feats, labels, "1998-01-12", "1998-03-16")


_SPLIT_SQL = _TRAIN_SQL + """,
sp AS (SELECT s.*, CASE WHEN dense_rank() OVER (ORDER BY feature_date) <= 6 THEN 'train' ELSE 'test' END AS split
       FROM snap s)"""


@register("temporal_split", _SPLIT_SQL + "\nSELECT * FROM sp")
def q_temporal_split(spark, sf_dir):
    """First six weekly snapshots train, the rest test (by date, not row order)."""
    return EV.temporal_split(training(spark, sf_dir), 6)


_TSTATS = ("tstats AS (SELECT " + ", ".join(
    f"avg(CAST({c} AS DOUBLE)) AS {c}_m, stddev_samp(CAST({c} AS DOUBLE)) AS {c}_s" for c in FEATS)
    + " FROM sp WHERE split = 'train')")


def _scaled_cols(src: str = "sp") -> str:
    return ", ".join(
        f"CASE WHEN tstats.{c}_s > 0 THEN (CAST({src}.{c} AS DOUBLE) - tstats.{c}_m) / tstats.{c}_s ELSE 0.0 END AS {c}"
        for c in FEATS)


@register("feature_scaling", _SPLIT_SQL + f",\n{_TSTATS}\nSELECT sp.user_id, sp.feature_date, sp.split, {_scaled_cols()}"
          " FROM sp, tstats")
def q_feature_scaling(spark, sf_dir):
    """Standardise with the train split's mean and sample std (StandardScaler)."""
    t = EV.temporal_split(stored(training(spark, sf_dir), "training"), 6)
    scaler = SC.fit_scaler(t.filter(F.col("split") == "train"))
    return SC.scale_features(t.drop("churned_30d"), scaler).select("user_id", "feature_date", "split", *FEATS)


def _test_scored(spark, sf_dir):
    """Test split scored by the fixed-weight model standardised on the train split."""
    t = EV.temporal_split(stored(training(spark, sf_dir), "training"), 6)
    m = SC.LogisticModel(SC.fit_scaler(t.filter(F.col("split") == "train")))
    return t.filter(F.col("split") == "test").select("user_id", "feature_date", "churned_30d",
                                                       m.probability().alias("churn_probability"))


_TM = "".join(f" + {SC.FIXED_WEIGHTS[c]} * (CASE WHEN tstats.{c}_s > 0 THEN (coalesce(CAST(sp.{c} AS DOUBLE), 0.0)"
              f" - tstats.{c}_m) / tstats.{c}_s ELSE 0.0 END)" for c in FEATS)
_TEST_SQL = _SPLIT_SQL + f""",
{_TSTATS},
ts_ AS (SELECT sp.user_id, sp.feature_date, sp.churned_30d,
               1.0 / (1.0 + exp(-({SC.FIXED_INTERCEPT}{_TM}))) AS churn_probability
        FROM sp, tstats WHERE split = 'test')"""


@register("eval_auc", _TEST_SQL + """,
c AS (SELECT churn_probability AS s, count(*) FILTER (WHERE churned_30d = 1) AS pos,
             count(*) FILTER (WHERE churned_30d = 0) AS neg FROM ts_ GROUP BY 1),
cu AS (SELECT *, sum(neg) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) AS cum_neg FROM c)
SELECT CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
       CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * ((cum_neg - neg) + 0.5 * neg)) / (sum(pos) * sum(neg)) END
         AS auc
FROM cu""")
def q_eval_auc(spark, sf_dir):
    """ROC AUC (tie-averaged Mann-Whitney) on the test split."""
    return EV.auc(_test_scored(spark, sf_dir))


def _rates_sql(pred: str, group: str = "") -> str:
    g = f"{group}, " if group else ""
    return f"""SELECT {g}tp, fp, fn, tn,
       CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS precision,
       CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS recall,
       CASE WHEN tp + fp > 0 AND tp + fn > 0 AND tp / (tp + fp) + tp / (tp + fn) > 0
            THEN 2.0 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)) END AS f1,
       (tp + tn) / (tp + fp + fn + tn) AS accuracy"""


@register("eval_confusion", _TEST_SQL + """,
cm AS (SELECT count(*) FILTER (WHERE churn_probability >= 0.5 AND churned_30d = 1) AS tp,
              count(*) FILTER (WHERE churn_probability >= 0.5 AND churned_30d = 0) AS fp,
              count(*) FILTER (WHERE churn_probability < 0.5 AND churned_30d = 1) AS fn,
              count(*) FILTER (WHERE churn_probability < 0.5 AND churned_30d = 0) AS tn FROM ts_)
""" + _rates_sql("") + " FROM cm")
def q_eval_confusion(spark, sf_dir):
    """Precision, recall, F1 and accuracy at 0.5 on the test split."""
    return EV.confusion(_test_scored(spark, sf_dir))


@register("threshold_analysis", _TEST_SQL + f""",
th AS (SELECT * FROM (VALUES {", ".join(f"(CAST({t} AS DOUBLE))" for t in EV.THRESHOLDS)}) v(threshold)),
cm AS (SELECT threshold,
              count(*) FILTER (WHERE churn_probability >= threshold AND churned_30d = 1) AS tp,
              count(*) FILTER (WHERE churn_probability >= threshold AND churned_30d = 0) AS fp,
              count(*) FILTER (WHERE churn_probability < threshold AND churned_30d = 1) AS fn,
              count(*) FILTER (WHERE churn_probability < threshold AND churned_30d = 0) AS tn
       FROM ts_, th GROUP BY threshold)
""" + _rates_sql("", "threshold") + " FROM cm")
def q_threshold_analysis(spark, sf_dir):
    return EV.threshold_analysis(_test_scored(spark, sf_dir))


@register("prediction_summary", _TEST_SQL + """
SELECT count(churn_probability) AS count, avg(churn_probability) AS mean, stddev_samp(churn_probability) AS std,
       min(churn_probability) AS min, quantile_cont(churn_probability, 0.25) AS p25,
       quantile_cont(churn_probability, 0.5) AS p50, quantile_cont(churn_probability, 0.75) AS p75,
       max(churn_probability) AS max FROM ts_""")
def q_prediction_summary(spark, sf_dir):
    return EV.prediction_summary(_test_scored(spark, sf_dir))


@register("prediction_distribution", _TEST_SQL + """,
h AS (SELECT least(CAST(floor(churn_probability * 10) AS BIGINT) + 1, 10) AS bin, count(*) AS n FROM ts_ GROUP BY 1)
SELECT bin, (bin - 1) / 10.0 AS lower, bin / 10.0 AS upper, n FROM h""")
def q_prediction_distribution(spark, sf_dir):
    """Histogram of test-split scores in ten equal bins."""
    return EV.prediction_histogram(_test_scored(spark, sf_dir))


_TERMS = ", ".join(f"('{t}')" for t in ("intercept", *FEATS))


@register("lr_fit", _SPLIT_SQL + f"""
SELECT term, (SELECT count(*) FROM sp WHERE split = 'train') AS train_rows, true AS at_optimum
FROM (VALUES {_TERMS}) t(term)""")
def q_lr_fit(spark, sf_dir):
    """pyspark.ml logistic regression on the train split, checked by the gradient
    of its penalised loss: zero in every term, up to 1e-4, over all train rows."""
    t = EV.temporal_split(stored(training(spark, sf_dir), "training"), 6).filter(F.col("split") == "train")
    g = EV.logistic_gradient(t, EV.fit_logistic(t, c=1.0, max_iter=200))
    return g.select("term", "train_rows", (F.abs("gradient") < F.lit(1e-4)).alias("at_optimum"))


# the same fit in plain SQL, by Newton steps over the train rows; solvers agree to four decimals
_FIT_SQL = _SPLIT_SQL + f""",
{_TSTATS},
tr AS MATERIALIZED (SELECT sp.user_id, CAST(sp.churned_30d AS DOUBLE) AS y_, {_scaled_cols()}
                    FROM sp, tstats WHERE split = 'train'),
{O.newton_sql("tr", "y_", FEATS, 8)}"""
_FIT_SCORE = "1.0 / (1.0 + exp(-(w.w0" + "".join(
    f" + w.w{i} * CASE WHEN tstats.{c}_s > 0 THEN (CAST(v.{c} AS DOUBLE) - tstats.{c}_m) / tstats.{c}_s ELSE 0.0 END"
    for i, c in enumerate(FEATS, 1)) + ")))"
_FIT_AUC = _FIT_SQL + f""",
fs AS (SELECT v.churned_30d, {_FIT_SCORE} AS s FROM sp v, tstats, nw_w w WHERE v.split = 'test'),
c AS (SELECT s, count(*) FILTER (WHERE churned_30d = 1) AS pos, count(*) FILTER (WHERE churned_30d = 0) AS neg
      FROM fs GROUP BY 1),
cu AS (SELECT *, sum(neg) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) AS cum_neg FROM c),
au AS (SELECT CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
              sum(pos * ((cum_neg - neg) + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM cu)"""


@register("lr_coefficients", _FIT_SQL + "\n" + "\nUNION ALL ".join(
    f"SELECT '{t}' AS term, round(w{i}, 4) AS coefficient FROM nw_w" for i, t in enumerate(("intercept", *FEATS))))
def q_lr_coefficients(spark, sf_dir):
    """The 11 fitted parameters, to the four decimals on which solvers agree."""
    t = EV.temporal_split(stored(training(spark, sf_dir), "training"), 6).filter(F.col("split") == "train")
    return (EV.model_coefficients(spark, EV.fit_logistic(t, c=1.0, max_iter=200))
            .withColumn("coefficient", F.round("coefficient", 4)))


@register("lr_eval_auc", _FIT_AUC + "\nSELECT n_pos, n_neg, auc > 0.5 AS better_than_chance FROM au")
def q_lr_eval_auc(spark, sf_dir):
    """The fitted pipeline on the test split: its classes, and whether it ranks
    them better than chance; `lr_test_auc` has the AUC."""
    return _test_auc(spark, sf_dir).select("n_pos", "n_neg", (F.col("auc") > 0.5).alias("better_than_chance"))


@register("lr_test_auc", _FIT_AUC + "\nSELECT n_pos, n_neg, round(auc, 4) AS auc FROM au")
def q_lr_test_auc(spark, sf_dir):
    """AUC of the fitted pipeline on the test split, to four decimals."""
    return _test_auc(spark, sf_dir).withColumn("auc", F.round("auc", 4))


def _test_auc(spark, sf_dir):
    t = EV.temporal_split(stored(training(spark, sf_dir), "training"), 6)
    pm = EV.fit_logistic(t.filter(F.col("split") == "train"), c=1.0, max_iter=200)
    from pyspark.ml.functions import vector_to_array
    pred = pm.transform(t.filter(F.col("split") == "test").withColumn("churned_30d", F.col("churned_30d").cast("double")))
    scored_ = pred.select(vector_to_array("probability")[1].alias("churn_probability"),
                          F.col("churned_30d").cast("int").alias("churned_30d"))
    return EV.auc(scored_)


@register("score_fitted", _FIT_SQL + f""",
lv AS (SELECT * FROM snap QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY feature_date DESC) = 1),
sc AS (SELECT v.user_id, v.feature_date, {_FIT_SCORE} AS p FROM lv v, tstats, nw_w w)
SELECT u.user_id, round(sc.p, 3) AS churn_probability, CAST(sc.p >= 0.5 AS INTEGER) AS predicted_label,
       CASE WHEN sc.p IS NOT NULL THEN 'ok' ELSE 'no_features' END AS status, sc.feature_date AS vector_date
FROM users u LEFT JOIN sc ON sc.user_id = u.user_id""")
def q_score_fitted(spark, sf_dir):
    """The pipeline fitted on the train split is saved, loaded and scores every user
    from the latest training vector; probabilities to three decimals."""
    t = stored(training(spark, sf_dir), "training")
    train = EV.temporal_split(t, 6).filter(F.col("split") == "train")
    path = EV.save_model(EV.fit_logistic(train, c=1.0, max_iter=200), f"{scratch_path(spark, 'model')}/m")
    model_ = SC.model_of(EV.load_model(path))
    users = mapping_b(spark, sf_dir).users
    return (SC.score_batch(users, SC.latest_features(t.drop("churned_30d")), model_)
            .withColumn("churn_probability", F.round("churn_probability", 3)))
