"""Evaluation of scored rows (key, label, prediction, probability, model); any number of models per pass."""

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep import defaults as D
from upkeep.functions import scalars as S
from upkeep.operators.running import prefix_scan

CELLS = ["tn", "fp", "fn", "tp"]


def _cell_sums(label):
    def hit(y, z):
        return F.count_if((F.col(label) == y) & (F.col("prediction") == z))

    return [hit(0, 0).alias("tn"), hit(0, 1).alias("fp"), hit(1, 0).alias("fn"), hit(1, 1).alias("tp")]


def confusion(scored: DataFrame, label: str = "label", by: tuple = ("model",)) -> DataFrame:
    """Per model the four cells, zero where a class is missing, and the matrix [[tn, fp], [fn, tp]]."""
    cells = scored.groupBy(*by).agg(*_cell_sums(label))
    return cells.withColumn("matrix", F.array(F.array("tn", "fp"), F.array("fn", "tp")))


def _f1(tp, fp, fn):
    return S.ratio_or_zero(2 * F.col(tp), 2 * F.col(tp) + F.col(fp) + F.col(fn))


def binary_metrics(cells: DataFrame) -> DataFrame:
    """Add accuracy, and precision, recall, F1 of class 1; 0 where a denominator is zero."""
    return cells.withColumns({
        "accuracy": S.ratio_or_zero(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")),
        "precision": S.ratio_or_zero("tp", F.col("tp") + F.col("fp")),
        "recall": S.ratio_or_zero("tp", F.col("tp") + F.col("fn")),
        "f1": _f1("tp", "fp", "fn"),
    })


def _sides():
    """Per class: its name and the expressions of precision, recall, F1 and support on the cells."""
    out = []
    for c, hit, wrong, missed in ((0, "tn", "fn", "fp"), (1, "tp", "fp", "fn")):
        out.append((D.CLASS_NAMES[c], {
            "precision": S.ratio_or_zero(hit, F.col(hit) + F.col(wrong)),
            "recall": S.ratio_or_zero(hit, F.col(hit) + F.col(missed)),
            "f1": _f1(hit, wrong, missed),
            "support": F.col(hit) + F.col(missed),
        }))
    return out


def per_class_report(cells: DataFrame) -> DataFrame:
    """(model, class, precision, recall, f1, support), two rows per model."""
    rows = [F.struct(F.lit(name).alias("class"), *[e.alias(c) for c, e in side.items()]) for name, side in _sides()]
    return cells.select("model", F.inline(F.array(*rows)))


STEPS = ["pos", "neg"]


def score_scan(scored: DataFrame, label: str = "label") -> DataFrame:
    """One row per model and distinct score, rising: the four cells and both classes there, and the classes below.

    The one pass over the scores from which cells, area and curve all come. Copies of a score are merged before any ordering.
    """
    classes = [F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")]
    return prefix_scan(scored.groupBy("model", "probability").agg(*classes, *_cell_sums(label)), "model", "probability", STEPS)


def _cells_of(scan):
    cells = scan.groupBy("model").agg(*[F.sum(c).alias(c) for c in CELLS])
    return cells.withColumn("matrix", F.array(F.array("tn", "fp"), F.array("fn", "tp")))


def roc_auc(scored: DataFrame, label: str = "label", scan: DataFrame = None) -> DataFrame:
    """(model, auc_roc): exact area, tied scores counting half; null when a class is missing."""
    pairs = F.sum(F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / 2))
    return (scan or score_scan(scored, label)).groupBy("model").agg(
        F.try_divide(pairs, F.sum("pos").cast("double") * F.sum("neg")).alias("auc_roc")
    )


def roc_curve(scored: DataFrame, label: str = "label", digits: int = None, scan: DataFrame = None) -> DataFrame:
    """(model, threshold, fpr, tpr): from (0, 0) by falling distinct score.

    A point is left out where it lies midway between its neighbours (both second differences are
    zero). Every remaining point is kept; `digits` rounds the rates.
    """
    scan = scan or score_scan(scored, label)
    totals = scan.groupBy("model").agg(F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
    joined = scan.join(totals, "model")
    ends = F.col("pos_before").isNull() | ((F.col("pos_below") + F.col("pos") == F.col("__p")) & (F.col("neg_below") + F.col("neg") == F.col("__n")))
    kept = joined.where(ends | (F.col("pos_before") != F.col("pos")) | (F.col("neg_before") != F.col("neg")))
    points = kept.select(
        "model", F.col("probability").alias("threshold"),
        S.ratio(F.col("__n") - F.col("neg_below"), "__n").alias("fpr"), S.ratio(F.col("__p") - F.col("pos_below"), "__p").alias("tpr"))
    start = totals.select("model", F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    out = points.unionByName(start)
    if digits is None:
        return out
    return out.withColumns({c: F.round(c, digits) for c in ("fpr", "tpr")})


def roc_arrays(curve: DataFrame, points: str = "distinct") -> DataFrame:
    """(model, fpr, tpr) as arrays of rates at 4 digits.

    `points="distinct"` has each pair of rates once: a monotone curve has at most 20 001 of them, so the arrays are
    bounded. `points="all"` repeats them as often as the curve does, as published documents of small data have them; its
    arrays grow with the number of distinct scores. `roc_curve` has all points as rows.
    """
    if points not in ("distinct", "all"):
        raise ValueError(f"points is 'distinct' or 'all', not {points!r}")
    rates = curve.select("model", F.round("fpr", 4).alias("f"), F.round("tpr", 4).alias("t"))
    points = rates.distinct() if points == "distinct" else rates
    return points.groupBy("model").agg(F.array_sort(F.collect_list(F.struct("f", "t"))).alias("p")).select(
        "model", F.col("p.f").alias("fpr"), F.col("p.t").alias("tpr")
    )


def fold_f1(scored: DataFrame, label: str = "label", fold: str = "fold") -> DataFrame:
    """(model, fold, f1) from predictions that carry their held-out fold."""
    return binary_metrics(confusion(scored, label, ("model", fold))).select("model", fold, "f1")


def cv_summary(folds: DataFrame) -> DataFrame:
    """(model, cv_f1_mean, cv_f1_std): mean and population deviation over folds."""
    return folds.groupBy("model").agg(F.avg("f1").alias("cv_f1_mean"), F.stddev_pop("f1").alias("cv_f1_std"))


def cross_validate(
    train: DataFrame, fit, model: str, label: str = "label", fold: str = "fold", k: int = D.FOLDS, resample=None, parallelism: int = D.FOLDS
) -> DataFrame:
    """Held-out F1 per fold, the model refitted for each: (model, fold, f1).

    `fit(train)` returns a function scoring a table. With `resample`, e.g. SMOTE, only each
    training part is resampled, so no synthetic twin of a held-out row is trained on. Fits of
    different folds are submitted together, so one fold's short stages leave no executors idle.
    """
    def held_out(j):
        part = train.where(F.col(fold) != j)
        scorer = fit(resample(part) if resample else part)
        return scorer(train.where(F.col(fold) == j)).select(label, "prediction", fold)

    with ThreadPool(parallelism) as pool:
        scored = pool.map(held_out, range(k))
    return fold_f1(reduce(DataFrame.unionByName, scored).withColumn("model", F.lit(model)), label, fold)


def hypothesis_check(metrics: DataFrame, min_recall: float = D.MIN_RECALL) -> DataFrame:
    """Unrounded recall against the minimum, with the verdict."""
    return metrics.select(
        "model", F.lit(float(min_recall)).alias("min_recall"), "recall", (F.col("recall") >= min_recall).alias("verified")
    ).withColumn("verdict", S.verdict("verified"))


def all_models_pass(checked: DataFrame) -> DataFrame:
    return checked.agg(F.bool_and("verified").alias("all_pass"))


def flat_metrics(scored: DataFrame, label: str = "label", cv: DataFrame = None, min_recall: float = D.MIN_RECALL, scan: DataFrame = None) -> DataFrame:
    """One unrounded row per model: cells, metrics, AUC, cross-validation, verdict. `scan` is `score_scan`'s table, if made already."""
    scan = scan or score_scan(scored, label)
    rows = binary_metrics(_cells_of(scan)).join(roc_auc(scored, label, scan), "model")
    if cv is None:
        rows = rows.withColumns({c: F.lit(None).cast("double") for c in ("cv_f1_mean", "cv_f1_std")})
    else:
        rows = rows.join(cv, "model", "left")
    return rows.withColumn("verified", F.col("recall") >= min_recall)


def evaluate_models(
    scored: DataFrame, label: str = "label", cv: DataFrame = None, min_recall: float = D.MIN_RECALL, roc: str = "distinct"
) -> DataFrame:
    """The nested metrics record of each model, scalars rounded to 4 digits.

    Field names are those of the published metrics documents. `roc` is `roc_arrays`' choice of points, None for no curve.
    """
    def r(c):
        return F.round(c, 4)

    scan = score_scan(scored, label)
    flat = flat_metrics(scored, label, cv, min_recall, scan)
    sides = F.create_map(*[
        x for name, side in _sides()
        for x in (F.lit(name), F.struct(*[(e if c == "support" else F.round(e, 4)).alias(c) for c, e in side.items()]))
    ])
    rows = flat.withColumn("por_clase", sides)
    if roc:
        rows = rows.join(roc_arrays(roc_curve(scored, label, scan=scan), roc), "model", "left")
    else:
        rows = rows.withColumns({c: F.lit(None).cast("array<double>") for c in ("fpr", "tpr")})
    return rows.select(
        "model", F.col("model").alias("nombre"), F.current_timestamp().alias("timestamp"),
        *[r(c).alias(c) for c in ("accuracy", "precision", "recall", "f1", "auc_roc", "cv_f1_mean", "cv_f1_std")],
        F.struct(*CELLS, "matrix").alias("confusion_matrix"), "por_clase",
        F.struct("fpr", "tpr").alias("curva_roc"),
        F.struct(
            F.lit(float(min_recall)).alias("recall_minimo"), r("recall").alias("recall_obtenido"), F.col("verified").alias("verificada")
        ).alias("hipotesis"),
    )


CARRIED = ["feature_importance", "coeficientes", "hiperparametros", "cv_f1_mean", "cv_f1_std"]


def merge_previous_metrics(current: DataFrame, previous: DataFrame, carried: list = None) -> DataFrame:
    """Current rows with the carried fields of the stored row of the same model, where it has them."""
    fields = [c for c in (carried or CARRIED) if c in previous.columns]
    stored = previous.select("model", *[F.col(c).alias(f"__{c}") for c in fields])
    joined = current.join(stored, "model", "left")
    merged = {c: F.coalesce(F.col(f"__{c}"), F.col(c)) if c in current.columns else F.col(f"__{c}") for c in fields}
    return joined.withColumns(merged).select(*current.columns, *[c for c in fields if c not in current.columns])


def require_models(metrics: DataFrame) -> DataFrame:
    """Raise ValueError when no model was evaluated."""
    if metrics.isEmpty():
        raise ValueError("no model to evaluate")
    return metrics
