"""Pieces shared by the registered queries: column rounding, prepared data, fitted models, SQL."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import fixture as X
from upkeep.functions.scalars import ratio
from upkeep.operators import prep
from upkeep.operators.bounds import settle
from upkeep.operators.columns import encode_category, select_features
from upkeep.operators.smote import smote
from upkeep.operators.train import fit_decision_tree, fit_logistic_regression, fit_random_forest, score_models
from upkeep.operators.trees import bag_count, fit_bagged_forest, left_out, reached, tree_nodes

LABEL = "failure"
CODED = [*X.FEATURES, "kind_code"]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles at 6 digits, so that engines summing in another order agree."""
    return df.select(*[
        (F.round(F.col(f"`{n}`"), digits) + F.lit(0.0)).alias(n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes
    ])


def split(spark, d):
    return X.once(spark, d, "split", lambda: settle(
        prep.stratified_split(encode_category(X.readings(spark, d), "kind", "kind_code"), "k", LABEL)
    ))


def train_raw(spark, d):
    return split(spark, d).where("split = 'train'")


def scaler(spark, d):
    return X.once(spark, d, "scaler", lambda: settle(prep.fit_scaler(train_raw(spark, d), CODED).coalesce(1)))


def scaled(spark, d, part):
    return prep.apply_scaler(split(spark, d).where(F.col("split") == part).drop("split"), scaler(spark, d), CODED, digits=9)


def balanced(spark, d):
    return X.once(spark, d, "balanced", lambda: settle(smote(scaled(spark, d, "train"), "k", CODED, LABEL)))


def ready(spark, d):
    """Balanced rows as (k, features, label)."""
    return select_features(balanced(spark, d), "k", CODED, LABEL)


def tree(spark, d):
    return X.once(spark, d, "tree", lambda: fit_decision_tree(ready(spark, d)))


def forest(spark, d):
    return X.once(spark, d, "forest", lambda: fit_random_forest(ready(spark, d)))


def forest_nodes(spark, d):
    return X.once(spark, d, "forest_nodes", lambda: tree_nodes(forest(spark, d)))


def logistic(spark, d):
    return X.once(spark, d, "logistic", lambda: fit_logistic_regression(ready(spark, d)))


def test_rows(spark, d):
    return select_features(scaled(spark, d, "test"), "k", CODED, LABEL)


SHORT = ["f1", "f3", "f4", "f5", "kind_code"]  # features of few values, whose splits SQL can list
SMALL_TREES = 3


def small_forest(spark, d):
    """A bagged forest small enough for SQL to grow it again."""
    return X.once(spark, d, "small_forest", lambda: fit_bagged_forest(
        select_features(train_raw(spark, d), "k", SHORT, LABEL), "k", trees=SMALL_TREES, max_depth=2, max_features="all"))


PAIR = ["f1", "f4"]


def pair_rows(spark, d):
    return select_features(scaled(spark, d, "train"), "k", PAIR, LABEL)


def bags(spark, d):
    """The (row, tree) pairs that the small forest was grown on, with their leaf and weight."""
    forest = small_forest(spark, d)
    rows = prep.weighted(select_features(train_raw(spark, d), "k", SHORT, LABEL, as_vector=False), True)
    own = bag_count(forest.seed, F.col("tree"), "k")
    return reached(rows, forest.nodes, ["k", "label", "weight"], when=~left_out(forest.seed, F.col("tree"), "k")).withColumn("weight", F.col("weight") * own)


def model_scores(spark, d):
    def build():
        models = {"tree": tree(spark, d), "forest": forest(spark, d), "logistic": logistic(spark, d)}
        return settle(score_models(models, test_rows(spark, d), ["k", F.col("label").cast("int").alias("label")]))

    return X.once(spark, d, "model_scores", build)


# --- SQL for DuckDB ---

READINGS = f"readings AS ({X.readings_sql()})"
SCORED = f"scored AS ({X.scored_sql()})"
_F = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in X.FEATURES)
_IN = ", ".join(X.FEATURES)
LONG = f"long AS (SELECT * FROM (SELECT k, kind, failure, {', '.join(X.MODES)}, {_F} FROM readings) UNPIVOT (value FOR variable IN ({_IN})))"
SIZES = """sizes AS (
  SELECT failure, n, n - CAST(w AS BIGINT) - CAST(place <= n_train - sum(w) OVER () AS BIGINT) AS n_test FROM (
    SELECT *, row_number() OVER (ORDER BY share - w DESC, failure) AS place FROM (
      SELECT failure, n, n_train, n * n_train / total AS share, floor(n * n_train / total) AS w FROM (
        SELECT failure, count(*) AS n, sum(count(*)) OVER () AS total,
               sum(count(*)) OVER () - ceil(sum(count(*)) OVER () * CAST(0.2 AS DOUBLE)) AS n_train
        FROM readings GROUP BY failure))))"""
SPLIT = """codes AS (SELECT kind, CAST(row_number() OVER (ORDER BY kind) - 1 AS INTEGER) AS kind_code FROM (SELECT DISTINCT kind FROM readings)),
split AS (SELECT r.*, c.kind_code, CASE WHEN row_number() OVER (PARTITION BY r.failure ORDER BY md5('42|' || k), k) <= s.n_test THEN 'test' ELSE 'train' END AS split
  FROM readings r JOIN sizes s USING (failure) JOIN codes c ON r.kind = c.kind)"""
_P = ", ".join(f"avg({f}) AS mu_{f}, CASE WHEN stddev_pop({f}) = 0 THEN 1 ELSE stddev_pop({f}) END AS sd_{f}" for f in CODED)
_Z = ", ".join(f"round(({f} - mu_{f}) / sd_{f}, 9) AS {f}" for f in CODED)
SCALED = f"""params AS (SELECT {_P} FROM split WHERE split = 'train'),
scaled AS (SELECT k, failure, split, {_Z} FROM split, params)"""
METRICS = """cells AS (SELECT model, count(*) FILTER (failure = 0 AND prediction = 0) AS tn, count(*) FILTER (failure = 0 AND prediction = 1) AS fp,
  count(*) FILTER (failure = 1 AND prediction = 0) AS fn, count(*) FILTER (failure = 1 AND prediction = 1) AS tp FROM scored GROUP BY model),
metrics AS (SELECT *, (tp + tn) / (tp + tn + fp + fn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
  coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM cells)"""
AUC = """byscore AS (SELECT model, probability, count(*) FILTER (failure = 1) AS pos, count(*) FILTER (failure = 0) AS neg FROM scored GROUP BY 1, 2),
auc AS (SELECT model, sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) AS auc_roc FROM (
  SELECT *, CAST(sum(neg) OVER (PARTITION BY model ORDER BY probability) - neg AS DOUBLE) AS below FROM byscore) GROUP BY model)"""
FLAT = """flat AS (SELECT *, CASE model WHEN 'rule_a' THEN 0 WHEN 'rule_b' THEN 1 ELSE 2 END AS ordinal FROM metrics JOIN auc USING (model))"""


def with_(*parts, select):
    return "WITH " + ",\n".join(parts) + "\n" + select
