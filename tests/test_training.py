"""Temporal split, pyspark.ml fit, and the distributed AUC against Spark ML's evaluator."""
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnlake.operators import evaluate as EV
from churnlake.operators import features as FE
from churnlake.sources.tables import mapping_b

SF = "/root/testdata/sf0.01"


def test_split_fit_and_auc_agree_with_spark_ml(spark):
    t = EV.temporal_split(FE.training_dataset(mapping_b(spark, SF), "1998-01-05", 12, 7), 6).cache()
    dates = {r["split"]: r["n"] for r in t.groupBy("split").agg(F.countDistinct("feature_date").alias("n")).collect()}
    assert dates == {"train": 6, "test": 6}
    last_train = t.filter("split = 'train'").agg(F.max("feature_date")).collect()[0][0]
    first_test = t.filter("split = 'test'").agg(F.min("feature_date")).collect()[0][0]
    assert last_train < first_test
    pm = EV.fit_logistic(t.filter("split = 'train'"), c=1.0, max_iter=50)
    pred = pm.transform(t.filter("split = 'test'").withColumn("churned_30d", F.col("churned_30d").cast("double")))
    spark_auc = BinaryClassificationEvaluator(labelCol="churned_30d", rawPredictionCol="rawPrediction",
                                              metricName="areaUnderROC", numBins=0).evaluate(pred)
    scored = pred.select(vector_to_array("probability")[1].alias("churn_probability"),
                         F.col("churned_30d").cast("int").alias("churned_30d"))
    ours = EV.auc(scored).collect()[0]["auc"]
    assert abs(ours - spark_auc) < 1e-6
    assert ours > 0.5   # better than chance on next-month inactivity
    coefs = EV.model_coefficients(spark, pm).collect()
    assert len(coefs) == 11 and all(abs(r["coefficient"]) < 1e3 for r in coefs)
    t.unpersist()


def test_gradient_shows_whether_a_fit_is_at_its_optimum(spark):
    import random
    rnd = random.Random(3)
    rows = [(x := rnd.gauss(0, 1), rnd.gauss(0, 2), int(rnd.random() < (0.8 if x > 0 else 0.3))) for _ in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, churned_30d int")
    for iters, right in ((200, True), (1, False)):
        pm = EV.fit_logistic(df, features=("a", "b"), max_iter=iters)
        g = EV.logistic_gradient(df, pm, features=("a", "b")).collect()
        assert {r["term"] for r in g} == {"intercept", "a", "b"} and {r["train_rows"] for r in g} == {400}
        assert (max(abs(r["gradient"]) for r in g) < 1e-4) == right


def test_auc_of_the_fitted_model_is_a_query(spark, sf001):
    import __spark_entry__ as E
    flag, full = (E.queries()[k](spark, sf001).first() for k in ("lr_eval_auc", "lr_test_auc"))
    assert (full["n_pos"], full["n_neg"]) == (flag["n_pos"], flag["n_neg"])
    assert 0.5 < full["auc"] < 1 and flag["better_than_chance"]


def newton_fit(x, y):
    """Logistic regression on standardised columns, mean loss and L2 of 1/n, by Newton steps."""
    import numpy as np
    n = len(y)
    mean, std = x.mean(0), x.std(0, ddof=1)
    z = np.hstack([np.ones((n, 1)), np.where(std > 0, (x - mean) / np.where(std > 0, std, 1), 0)])
    w, ridge = np.zeros(z.shape[1]), np.diag([0.0] + [1.0 / n] * x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ w))
        hess = (z * (p * (1 - p))[:, None]).T @ z / n + ridge + 1e-12 * np.eye(len(w))
        w -= np.linalg.solve(hess, z.T @ (p - y) / n + ridge @ w)

    def probability(rows):
        v = np.where(std > 0, (rows - mean) / np.where(std > 0, std, 1), 0)
        return 1 / (1 + np.exp(-(w[0] + v @ w[1:])))

    return probability


def test_fitted_model_scores_and_ranks_as_a_newton_fit(spark, sf001):
    """Coefficients pass through the ML writer into scoring; the AUC is counted pair by pair."""
    import numpy as np

    import __spark_entry__ as E
    from churnlake.sources import schemas as S
    t = EV.temporal_split(E.queries()["training_dataset"](spark, sf001), 6).collect()
    x = lambda rows: np.array([[float(r[c]) for c in S.FEATURE_COLUMNS] for r in rows])
    train, test = ([r for r in t if r["split"] == s] for s in ("train", "test"))
    probability = newton_fit(x(train), np.array([r["churned_30d"] for r in train], dtype=float))

    latest = {}
    for r in t:
        if r["user_id"] not in latest or r["feature_date"] > latest[r["user_id"]]["feature_date"]:
            latest[r["user_id"]] = r
    want = dict(zip(latest, probability(x(latest.values()))))
    got = E.queries()["score_fitted"](spark, sf001).collect()
    assert {r["user_id"] for r in got if r["status"] == "ok"} == set(want)
    for r in got:
        if r["status"] == "ok":
            assert abs(r["churn_probability"] - want[r["user_id"]]) < 2e-3
            if abs(want[r["user_id"]] - 0.5) > 1e-3:  # the query's probabilities are rounded
                assert r["predicted_label"] == int(want[r["user_id"]] >= 0.5)

    p = probability(x(test))
    pos, neg = (p[[r["churned_30d"] == k for r in test]] for k in (1, 0))
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    r = E.queries()["lr_test_auc"](spark, sf001).first()
    assert (r["n_pos"], r["n_neg"]) == (len(pos), len(neg)) and abs(r["auc"] - auc) < 5e-3
