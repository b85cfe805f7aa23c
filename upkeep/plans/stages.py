"""The stages end to end: profile, prepare, train, evaluate, publish."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep import defaults as D
from upkeep.operators.bounds import settle
from upkeep.operators.columns import select_features
from upkeep.operators import correlation, profile, publish
from upkeep.operators.evaluate import cross_validate, cv_summary, evaluate_models, merge_previous_metrics
from upkeep.operators.prep import apply_scaler, fit_scaler, stratified_folds, stratified_split
from upkeep.operators.smote import smote
from upkeep.operators.trees import BaggedForest, fit_bagged_forest
from upkeep.operators.train import fit_decision_tree, fit_logistic_regression, fit_random_forest, model_records, score, score_models


def profiled(df: DataFrame, features: list = None, label: str = D.TARGET, modes: list = None, rules: list = None, falling=D.FALLING_RISK) -> dict:
    """Tables on the raw readings: classes, modes, contrast (t test), describe, intervals, zones, rules, target correlations, pairs."""
    return {
        "classes": profile.class_distribution(df, label), "modes": profile.mode_frequency(df, modes),
        "contrast": profile.class_contrast(df, features, label), "describe": profile.describe_features(df, features),
        "intervals": profile.mode_intervals(df, features, modes), "zones": profile.failure_q1_zones(df, features, label, falling),
        "rules": profile.validate_intervals(df, rules, label),
        "target": correlation.corr_with_target_signed(df, features, label), "pairs": correlation.corr_pairs(df, features),
    }


def prepare(df: DataFrame, key: str, features: list = None, label: str = D.TARGET, test_size: float = D.TEST_SIZE,
            seed: int = D.SEED, k: int = D.NEIGHBOURS, digits: int = None) -> dict:
    """Split, scale on the train part, rebalance the train part.

    Returns tables: split, scaler, train (scaled), test (scaled), balanced. The split rows and
    the balanced rows are written once, as every later step reads them.
    """
    features = features or D.FEATURES
    split = settle(stratified_split(df, key, label, test_size, seed))
    scaler = settle(fit_scaler(split.where("split = 'train'"), features).coalesce(1))
    train = apply_scaler(split.where("split = 'train'").drop("split"), scaler, features, digits)
    test = apply_scaler(split.where("split = 'test'").drop("split"), scaler, features, digits)
    balanced = settle(smote(train, key, features, label, k, seed))
    return {"split": split, "scaler": scaler, "train": train, "test": test, "balanced": balanced}


def train_models(balanced: DataFrame, key: str, features: list = None, label: str = D.TARGET, seed: int = D.SEED,
                 trees: int = D.FOREST_TREES, out_of_bag: bool = False) -> dict:
    """The three classifiers on the balanced rows, by published name.

    With `out_of_bag` the forest is a `BaggedForest`, which judges itself by the rows its trees did not draw.
    """
    ready = select_features(balanced, key, features, label).persist()
    try:
        return {
            D.TREE: fit_decision_tree(ready, seed=seed),
            D.FOREST: fit_bagged_forest(ready, key, trees, seed=seed) if out_of_bag else fit_random_forest(ready, trees=trees, seed=seed),
            D.LOGISTIC: fit_logistic_regression(ready),
        }
    finally:
        ready.unpersist()


def score_test(models: dict, test: DataFrame, key: str, features: list = None, label: str = D.TARGET) -> DataFrame:
    """Long scores of all models, written once: the evaluation reads them several times."""
    ready = select_features(test, key, features, label)
    return settle(score_models(models, ready, [key, F.col("label").cast("int").alias("label")]))


def evaluate(models: dict, test: DataFrame, key: str, features: list = None, label: str = D.TARGET, cv: DataFrame = None,
             oob: dict = None, min_recall: float = D.MIN_RECALL, balanced: DataFrame = None) -> DataFrame:
    """One record per model: its metrics on the test rows and what its training produced.

    With the `balanced` rows they were trained on, bagged forests add their own out-of-bag score.
    """
    if balanced is not None:
        ready = select_features(balanced, key, features, label)
        own = {n: m.oob_score(ready, key).first()["oob_accuracy"] for n, m in models.items() if isinstance(m, BaggedForest)}
        oob = {**own, **(oob or {})}
    order = F.create_map(*[x for i, m in enumerate(models) for x in (F.lit(m), F.lit(i))])
    records = evaluate_models(score_test(models, test, key, features, label), cv=cv, min_recall=min_recall)
    made = model_records(test.sparkSession, models, features or D.FEATURES, oob, cv)
    records = merge_previous_metrics(records, made, [c for c in made.columns if c != "model"])
    return records.withColumn("ordinal", order[F.col("model")])


def published(records: DataFrame, info: DataFrame = None, rules: list = None, meta: dict = None, min_recall: float = D.MIN_RECALL) -> dict:
    """What a run publishes from its records: the flat table, the dashboard document, the report's rows, the run's document."""
    return {
        "table": publish.metrics_table(records, min_recall), "dashboard": publish.dashboard_payload(records, info, rules, min_recall, meta=meta),
        "report": publish.metrics_long(records, rules, meta, min_recall), "record": publish.run_record(records, meta, min_recall),
    }


def cross_validated(balanced: DataFrame, key: str, fits: dict, features: list = None, label: str = D.TARGET, k: int = D.FOLDS,
                    seed: int = D.SEED) -> DataFrame:
    """(model, cv_f1_mean, cv_f1_std) for `fits`: name -> function from (key, features, label) rows to a model."""
    ready = select_features(balanced, key, features, label)
    folds = settle(stratified_folds(ready, key, "label", k, seed))
    out = None
    for name, fit in fits.items():
        def scorer(part, fit=fit):
            model = fit(part)
            return lambda rows: score(model, rows, ["label", "fold"])

        one = cross_validate(folds, scorer, name, k=k)
        out = one if out is None else out.unionByName(one)
    return cv_summary(out)
