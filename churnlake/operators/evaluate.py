"""Training matrix, temporal split, fit and evaluation.

AUC is the Mann-Whitney statistic with tie-averaged ranks, computed from
per-score class counts and distributed running totals (no global sort into
one task). Threshold sweeps explode each scored row to the (fixed, few)
thresholds and aggregate once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.functions import stats as ST
from churnlake.functions.timefn import ts
from churnlake.sources import schemas as S

# The threshold sweep of the evaluation report.
THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7)


def training_matrix(features: DataFrame, labels: DataFrame, start, end) -> DataFrame:
    """features join labels on (user_id, feature_date) for start <= date < end."""
    fd = F.col("feature_date")
    rng = (fd >= ts(start)) & (fd < ts(end))
    return features.filter(rng).join(labels.filter(rng), ["user_id", "feature_date"], "inner")


def temporal_split(df: DataFrame, train_dates: int = 6) -> DataFrame:
    """Adds ``split`` = train for the first ``train_dates`` snapshot dates, else test.

    The distinct dates are few (one per snapshot); they are ranked on their own
    and joined back, so no window spans the data."""
    dates = df.select("feature_date").distinct()
    ranked = dates.withColumn("_r", F.dense_rank().over(Window.orderBy("feature_date")))
    return (df.join(F.broadcast(ranked), "feature_date")
            .withColumn("split", F.when(F.col("_r") <= train_dates, "train").otherwise("test")).drop("_r"))


def auc(scored: DataFrame, score: str = "churn_probability", label: str = "churned_30d",
        by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC per group; null when a group has only one class."""
    by = list(by)
    counts = (scored.groupBy(*by, F.col(score).alias("s"))
              .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")))
    cum = ST.running_totals(counts, by, "s", ["neg"])
    part = F.col("pos") * ((F.col("cum_neg") - F.col("neg")) + F.lit(0.5) * F.col("neg"))
    agg = cum.groupBy(*by).agg(F.sum(part).alias("_u"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return agg.select(*by, "n_pos", "n_neg",
                      F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                             F.col("_u") / (F.col("n_pos") * F.col("n_neg"))).alias("auc"))


def _confusion(pred, actual):
    return [F.count_if((pred == 1) & (actual == 1)).alias("tp"), F.count_if((pred == 1) & (actual == 0)).alias("fp"),
            F.count_if((pred == 0) & (actual == 1)).alias("fn"), F.count_if((pred == 0) & (actual == 0)).alias("tn")]


def _rates(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision = F.try_divide(tp, tp + fp)
    recall = F.try_divide(tp, tp + fn)
    return df.select(*keep, "tp", "fp", "fn", "tn",
                     precision.alias("precision"), recall.alias("recall"),
                     F.try_divide(F.lit(2.0) * precision * recall, precision + recall).alias("f1"),
                     F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"))


def confusion(scored: DataFrame, threshold: float = 0.5, score: str = "churn_probability",
              label: str = "churned_30d") -> DataFrame:
    pred = (F.col(score) >= threshold).cast("int")
    return _rates(scored.agg(*_confusion(pred, F.col(label))), [])


def threshold_analysis(scored: DataFrame, thresholds: Sequence[float] = THRESHOLDS,
                       score: str = "churn_probability", label: str = "churned_30d") -> DataFrame:
    ex = scored.select(F.col(score).alias("s"), F.col(label).alias("y"),
                       F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold"))
    pred = (F.col("s") >= F.col("threshold")).cast("int")
    return _rates(ex.groupBy("threshold").agg(*_confusion(pred, F.col("y"))), ["threshold"])


def prediction_summary(scored: DataFrame, score: str = "churn_probability") -> DataFrame:
    """count, mean, std, min, exact quartiles (distributed), max of the scores."""
    x = F.col(score)
    m = scored.agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                   F.min(x).alias("min"), F.max(x).alias("max"))
    q = ST.exact_quantiles(scored.select(x.alias("_s")), [], "_s", [0.25, 0.5, 0.75])
    # one row each, side by side
    cols = ["count", "mean", "std", "min", "max", "q0", "q1", "q2"]
    both = m.unionByName(q, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in cols])
    return both.selectExpr("count", "mean", "std", "min", "q0 AS p25", "q1 AS p50", "q2 AS p75", "max")


def prediction_histogram(scored: DataFrame, bins: int = 10, score: str = "churn_probability") -> DataFrame:
    """Equal-width histogram over [0, 1]; a score of exactly 1 goes to the last bin."""
    b = F.least(F.width_bucket(F.col(score), F.lit(0.0), F.lit(1.0), F.lit(bins)), F.lit(bins))
    h = scored.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return h.select("bin", ((F.col("bin") - 1) / F.lit(float(bins))).alias("lower"),
                    (F.col("bin") / F.lit(float(bins))).alias("upper"), "n")


def feature_importance(contributions: DataFrame, top: int) -> DataFrame:
    """Mean |contribution| per feature over all scored users, top-n."""
    return (contributions.groupBy("feature_name")
            .agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
            .orderBy(F.col("mean_abs_contribution").desc(), "feature_name").limit(top))


def fit_logistic(train: DataFrame, features: Sequence[str] = S.FEATURE_COLUMNS, label: str = "churned_30d",
                 c: float = 1.0, max_iter: int = 100, tol: float = 1e-10):
    """pyspark.ml pipeline: VectorAssembler -> StandardScaler -> LogisticRegression.

    scikit-learn's C maps to an L2 ``regParam = 1 / (C * n)``; n is one count."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    n = train.count()
    asm = VectorAssembler(inputCols=list(features), outputCol="_raw")
    scl = StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True)
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter, tol=tol,
                            regParam=1.0 / (c * max(n, 1)), elasticNetParam=0.0)
    data = train.withColumn(label, F.col(label).cast("double"))
    return Pipeline(stages=[asm, scl, lr]).fit(data)


def save_model(pipeline_model, path: str) -> str:
    """Write a fitted pipeline with Spark's own ML writer (a folder that all
    executors and later sessions can read)."""
    pipeline_model.write().overwrite().save(path)
    return path


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)


def logistic_gradient(train: DataFrame, pipeline_model, label: str = "churned_30d",
                      features: Sequence[str] = S.FEATURE_COLUMNS) -> DataFrame:
    """(term, train_rows, gradient): the derivative of the penalised mean loss by
    every fitted parameter over all training rows. A fit is right when all are
    near zero, whatever solver made it."""
    from pyspark.ml.functions import vector_to_array

    lr = pipeline_model.stages[-1]
    reg = lr.getRegParam()
    z = vector_to_array("features")
    scored = pipeline_model.transform(train.withColumn(label, F.col(label).cast("double")))
    err = vector_to_array("probability")[1] - F.col(label)
    names = ["intercept", *features]
    slopes = [F.avg(err).alias("g0")] + [(F.avg(err * z[i]) + F.lit(reg * float(w))).alias(f"g{i + 1}")
                                         for i, w in enumerate(lr.coefficients)]
    row = scored.agg(F.count(F.lit(1)).alias("train_rows"), *slopes)
    stack = ", ".join(f"'{n}', g{i}" for i, n in enumerate(names))
    return row.selectExpr("train_rows", f"stack({len(names)}, {stack}) AS (term, gradient)")


def model_coefficients(spark, pipeline_model, features: Sequence[str] = S.FEATURE_COLUMNS) -> DataFrame:
    """(term, coefficient) of a fitted pipeline: the 11 fitted parameters."""
    lr = pipeline_model.stages[-1]
    rows = [("intercept", float(lr.intercept))] + [(f, float(w)) for f, w in zip(features, lr.coefficients)]
    return spark.createDataFrame(rows, "term string, coefficient double")
