"""Classifiers on Spark ML. Input: (key, features vector, label), as `select_features` gives."""

import math
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep import defaults as D
from upkeep.functions.scalars import sign_tag
from upkeep.operators import forest, logistic
from upkeep.operators.gram import gram
from upkeep.operators.prep import weighted  # noqa: F401
from upkeep.operators.trees import MAX_BINS, BaggedForest, fit_bagged_forest


def fit_decision_tree(train: DataFrame, max_depth: int = D.TREE_DEPTH, balanced: bool = True, seed: int = D.SEED, max_bins: int = MAX_BINS):
    """A Spark ML tree grown by `forest.grow` from all rows, which are binned once and not cached; only its cut points hang on the seed.

    What tells rows apart for these is as in `fit_random_forest`.
    """
    dims, row = _dims(train), _row(train)
    data = forest.binned(train, dims, max_bins, balanced, seed, row, bags=False)
    settings = dict(impurity="gini", maxDepth=max_depth, maxBins=max_bins, seed=seed, weightCol="weight", featuresCol="features", labelCol="label")
    return forest.as_tree(train.sparkSession, forest.grow(data, 1, max_depth, "all", seed), settings, dims, len(data.weights))


def _dims(train):
    return len(train.select("features").first()[0])


def _row(train):
    """What tells rows apart, as a long: all columns but features and label."""
    others = [c for c in train.columns if c not in ("features", "label", "weight")]
    return F.xxhash64(*others) if others else F.xxhash64(F.monotonically_increasing_id())


def fit_random_forest(
    train: DataFrame, trees: int = D.FOREST_TREES, max_depth: int = D.FOREST_DEPTH, balanced: bool = True, seed: int = D.SEED,
    max_bins: int = MAX_BINS,
):
    """A Spark ML forest grown by `forest.grow`, all trees at once: sqrt of the features a node, Poisson(1) draws.

    What tells rows apart is all columns but features and label (rows equal in these are drawn alike); without any, where a row lies.
    """
    dims, row = _dims(train), _row(train)
    data = forest.binned(train, dims, max_bins, balanced, seed, row)
    settings = dict(impurity="gini", numTrees=trees, maxDepth=max_depth, maxBins=max_bins, featureSubsetStrategy="sqrt", bootstrap=True,
                    seed=seed, weightCol="weight", featuresCol="features", labelCol="label")
    return forest.as_model(train.sparkSession, forest.grow(data, trees, max_depth, "sqrt", seed), settings, dims, len(data.weights))


def fit_logistic_regression(train: DataFrame, c: float = D.LOGISTIC_C, max_iter: int = D.LOGISTIC_ITERATIONS, tol: float = 1e-8):
    """L2 logistic regression of labels 0 and 1 by Newton's method (`logistic.minimise`), as a Spark ML model; Spark averages the loss, so its
    penalty is 1 / (C * rows). Other labels are left to Spark ML: it answers rows of one class without fitting, and refuses labels that are no classes.
    """
    own = [F.count_if(F.col("label") == v) for v in (0, 1)]
    n, none, some = train.agg(F.count(F.lit(1)), *own).first()
    settings = dict(elasticNetParam=0.0, regParam=1.0 / (c * n), standardization=False, maxIter=max_iter, tol=tol, featuresCol="features", labelCol="label")
    if not none or not some or none + some < n:
        return LogisticRegression(**settings).fit(train)
    dims = _dims(train)
    weights, used = logistic.minimise(logistic.packed(train, dims), dims, c, max_iter, tol, math.log(some / none))
    return logistic.as_model(train.sparkSession, weights.tolist(), settings, used)


def with_scaler(model, scaler: DataFrame, features: list) -> PipelineModel:
    """A model that takes raw readings: stored scaler, assembled vector, classifier.

    Scaler moments (one row per feature) become part of the saved model, as in a SQL transform.
    """
    p = {r["variable"]: (r["mean"], r["scale"]) for r in scaler.collect()}
    exprs = ", ".join(f"(CAST(`{f}` AS DOUBLE) - ({p[f][0]!r}D)) / ({p[f][1]!r}D) AS `__z_{f}`" for f in features)
    steps: list[Transformer] = [
        SQLTransformer(statement=f"SELECT *, {exprs} FROM __THIS__"),
        VectorAssembler(inputCols=[f"__z_{f}" for f in features], outputCol="features", handleInvalid="error"),
        model,
    ]
    return Pipeline(stages=steps).fit(scaler.sparkSession.createDataFrame([], _schema(features)))


def _schema(features):
    return ", ".join(f"`{f}` double" for f in features)


def score(model, df: DataFrame, keep: list, name: str = None) -> DataFrame:
    """(keep..., prediction, probability[, model]) per row; df may be a stream."""
    out = model.transform(df).select(
        *keep, F.col("prediction").cast("int").alias("prediction"), vector_to_array("probability")[1].alias("probability")
    )
    return out if name is None else out.withColumn("model", F.lit(name))


def score_models(models: dict, df: DataFrame, keep: list) -> DataFrame:
    """Scores of several classifiers in one pass over df, long: one row per input row and model.

    A `BaggedForest` scores by its node table, in a pass of its own.
    """
    bagged = {n: m for n, m in models.items() if isinstance(m, BaggedForest)}
    models = {n: m for n, m in models.items() if n not in bagged}
    out, kept = df, [F.col(c) if isinstance(c, str) else c for c in keep]
    tables = []
    for name, own in bagged.items():
        rows = df.select(*kept, vector_to_array("features").alias("features"))
        tables.append(own.score(rows, rows.columns[:-1]).withColumn("model", F.lit(name)))
    if not models:
        return reduce(DataFrame.unionByName, tables)
    for i, model in enumerate(models.values()):
        mine = model.copy()
        mine.setPredictionCol(f"__pred{i}").setProbabilityCol(f"__prob{i}").setRawPredictionCol(f"__raw{i}")
        out = mine.transform(out)
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("model"), F.col(f"__pred{i}").cast("int").alias("prediction"),
            vector_to_array(f"__prob{i}")[1].alias("probability"),
        )
        for i, name in enumerate(models)
    ])
    return reduce(DataFrame.unionByName, tables, out.select(*kept, F.inline(rows)))


def tree_shape(spark, model) -> DataFrame:
    """(depth, leaves, inner nodes) of a fitted tree."""
    leaves = (model.numNodes + 1) // 2
    return spark.createDataFrame([(model.depth, leaves, model.numNodes - leaves)], "depth int, leaves int, inner_nodes int")


def feature_importance(spark, model, features: list) -> DataFrame:
    """(rank, variable, importance), Gini importance falling; rank 1 is the top variable."""
    rows = sorted(zip(features, model.featureImportances.toArray().tolist()), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame([(i, v, x) for i, (v, x) in enumerate(rows, 1)], "rank int, variable string, importance double")


def coefficients(spark, model, features: list) -> DataFrame:
    """(rank, variable, coefficient, sign, intercept) by falling size, rounded to 4 digits."""
    rows = sorted(zip(features, model.coefficients.toArray().tolist()), key=lambda r: (-abs(r[1]), r[0]))
    table = spark.createDataFrame([(i, v, x, float(model.intercept)) for i, (v, x) in enumerate(rows, 1)], "rank int, variable string, c double, b double")
    return table.select("rank", "variable", F.round("c", 4).alias("coefficient"), sign_tag("c").alias("sign"), F.round("b", 4).alias("intercept"))


def newton_step(model, rows: DataFrame, features: list, c: float = D.LOGISTIC_C) -> DataFrame:
    """(variable, coefficient, step): what one more Newton step would take off each fitted value, the intercept last; near zero at the optimum.

    rows: (features array<double>, label). X'WX and X'(p - y) are one weighted Gram aggregate over one scan, of the features, a
    column of ones and (p - y) / w; only these (features + 2) squared sums reach the driver.
    """
    n, fitted = len(features), [float(x) for x in model.coefficients.toArray()]
    x = [F.get("features", F.lit(i)) for i in range(n)]
    wide = rows.select(*[v.alias(f"x{i}") for i, v in enumerate(x)], F.lit(1.0).alias("one"), "label",
                       (1 / (1 + F.exp(-sum((v * b for v, b in zip(x, fitted)), F.lit(float(model.intercept)))))).alias("p"))
    wide = wide.withColumn("w", F.greatest(F.col("p") * (1 - F.col("p")), F.lit(1e-15))).withColumn("z", (F.col("p") - F.col("label")) / F.col("w"))
    sums = gram(wide, [*[f"x{i}" for i in range(n)], "one", "z"], "w").select("i", "j", (F.col("both") + F.col("n") * F.col("mean_i") * F.col("mean_j")).alias("s")).collect()
    import numpy as np

    whole = np.zeros((n + 2, n + 2))
    for r in sums:
        whole[r["i"], r["j"]] = r["s"]
    penalty = np.diag([1.0 / c] * n + [0.0])
    values = np.array([*fitted, float(model.intercept)])
    step = np.linalg.solve(whole[: n + 1, : n + 1] + penalty, whole[: n + 1, n + 1] + penalty @ values)
    return rows.sparkSession.createDataFrame(list(zip([*features, "intercept"], values.tolist(), step.tolist())), "variable string, coefficient double, step double")


def convergence(spark, model) -> DataFrame:
    """(iterations, max_iterations, converged) of a model just fitted; iterations are Newton steps."""
    used, most = int(model.iterations if hasattr(model, "iterations") else model.summary.totalIterations), int(model.getMaxIter())
    return spark.createDataFrame([(used, most, used < most)], "iterations int, max_iterations int, converged boolean")


def model_params(spark, model) -> DataFrame:
    """(param, value) of every parameter in effect."""
    rows = sorted((p.name, str(v)) for p, v in model.extractParamMap().items())
    return spark.createDataFrame(rows, "param string, value string")


def model_records(spark, models: dict, features: list, oob: dict = None, cv: DataFrame = None) -> DataFrame:
    """What training leaves for each model's record, one row per model of `models` (name -> fitted model).

    Maps of importances or coefficients and the intercept (4 digits), the parameters as text, the real depth and
    leaf count of a tree, an out-of-bag score from `oob` (name -> score), and mean and deviation of F1 over folds from
    `cv` (model, cv_f1_mean, cv_f1_std); null where a model has none.
    """
    folds = {r["model"]: tuple(None if v is None else round(v, 4) for v in (r["cv_f1_mean"], r["cv_f1_std"])) for r in cv.collect()} if cv is not None else {}

    def rates(vector):
        return {v: round(float(x), 4) for v, x in zip(features, vector.toArray())}

    rows = []
    for name, m in models.items():
        if isinstance(m, BaggedForest):
            share = {r["variable"]: round(r["importance"], 4) for r in m.importances(features).collect()}
            hyper = {"max_depth": m.max_depth, "criterion": "gini", "random_state": m.seed, "n_estimators": m.trees, "max_features": m.max_features}
            rows.append((name, share, None, None, {k: str(v) for k, v in hyper.items()}, (oob or {}).get(name), None, None, *folds.get(name, (None, None))))
            continue
        tree, linear = hasattr(m, "featureImportances"), hasattr(m, "coefficients")
        single = tree and not hasattr(m, "trees")
        hyper = {"max_depth": m.getMaxDepth(), "criterion": m.getImpurity(), "random_state": m.getSeed()} if tree else {"max_iter": m.getMaxIter(), "reg_param": m.getRegParam()}
        if tree and not single:
            hyper |= {"n_estimators": m.getNumTrees, "max_features": m.getFeatureSubsetStrategy()}
        rows.append((
            name, rates(m.featureImportances) if tree else None, rates(m.coefficients) if linear else None,
            round(float(m.intercept), 4) if linear else None, {k: str(v) for k, v in hyper.items()},
            (oob or {}).get(name), m.depth if single else None, (m.numNodes + 1) // 2 if single else None,
            *folds.get(name, (None, None)),
        ))
    return spark.createDataFrame(rows, "model string, feature_importance map<string,double>, coeficientes map<string,double>, intercepto double, "
                                 "hiperparametros map<string,string>, oob_score double, profundidad_real int, num_hojas int, cv_f1_mean double, cv_f1_std double")


def oob_score(train: DataFrame, key: str, trees: int = D.FOREST_TREES, max_depth: int = D.FOREST_DEPTH, seed: int = D.SEED, max_bins: int = MAX_BINS,
              balanced: bool = True) -> DataFrame:
    """(trees, rows, oob_accuracy): fits a `trees.BaggedForest` and judges each row by its trees that did not draw it.

    Fit the forest yourself to score with it too. On rebalanced rows the figure is optimistic: a synthetic row has its
    parents in the bag.
    """
    return fit_bagged_forest(train, key, trees, max_depth, balanced, seed, max_bins).oob_score(train, key)
