"""The tree and the logistic model, whose rows are written once and scanned, against Spark ML's own fits."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression

from upkeep.operators import columns, train, trees


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=3000).round(2), rng.integers(0, 9, 3000), rng.normal(size=3000)])
    y = (rng.random(3000) < 1 / (1 + np.exp(-(x @ [1.5, -0.3, 0.8] + 0.4)))).astype(int)
    return columns.select_features(spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(k=[f"r{i}" for i in range(3000)], y=y)), "k", list("abc"), "y").cache()


@pytest.fixture
def fitted(monkeypatch):
    """Rows that Spark ML's estimators were fitted to, which they cache."""
    rows = []
    for kind in (DecisionTreeClassifier, LogisticRegression):
        own = kind.fit
        monkeypatch.setattr(kind, "fit", lambda self, data, *more, own=own: rows.append(data.count()) or own(self, data, *more))
    return rows


def test_a_tree_is_spark_mls_without_its_cached_rows(table, fitted):
    got = train.fit_decision_tree(table.repartition(5), max_depth=5)
    assert max(fitted, default=0) <= 2
    want = DecisionTreeClassifier(impurity="gini", maxDepth=5, maxBins=256, seed=42, weightCol="weight").fit(train.weighted(table, True))
    assert got.depth == want.depth and got.numNodes == want.numNodes and got.getWeightCol() == "weight"
    a, b = (trees.tree_nodes(m).orderBy("node").toPandas() for m in (got, want))
    assert (a.feature == b.feature).all()
    np.testing.assert_allclose(a[["threshold", "n0", "n1"]].astype(float), b[["threshold", "n0", "n1"]].astype(float), rtol=1e-9)
    np.testing.assert_allclose(got.featureImportances.toArray(), want.featureImportances.toArray(), atol=1e-9)


def test_a_logistic_model_is_spark_mls_without_its_cached_rows(spark, table, fitted, tmp_path):
    got = train.fit_logistic_regression(table.repartition(5), c=0.5)
    assert max(fitted, default=0) <= 2
    want = LogisticRegression(regParam=1 / (0.5 * 3000), standardization=False, maxIter=1000, tol=1e-12).fit(table)
    np.testing.assert_allclose([*got.coefficients, got.intercept], [*want.coefficients, want.intercept], atol=1e-6)
    told = train.convergence(spark, got).first()
    assert told["converged"] and 0 < told["iterations"] < 20 and told["max_iterations"] == 1000
    assert not train.convergence(spark, train.fit_logistic_regression(table, max_iter=1)).first()["converged"]


def test_separable_rows_and_one_class(spark):
    rows = columns.select_features(spark.createDataFrame([(i, float(i - 50) * 10, int(i > 50)) for i in range(100)], "k long, a double, y int"), "k", ["a"], "y")
    got = train.fit_logistic_regression(rows)
    want = LogisticRegression(regParam=1 / 100, standardization=False, maxIter=1000, tol=1e-14).fit(rows)
    np.testing.assert_allclose([*got.coefficients, got.intercept], [*want.coefficients, want.intercept], rtol=1e-3, atol=1e-3)
    one = train.fit_logistic_regression(rows.where("label = 1"))
    assert one.coefficients.toArray().tolist() == [0.0] and one.intercept == float("inf")
