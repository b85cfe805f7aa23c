"""Choice and order of models; tables have one row per model and an `ordinal` of input order."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep import defaults as D
from upkeep.functions import scalars as S

def _ranked(metrics, min_recall, ordinal):
    """Place 1 is the winner: models passing the recall gate first, if any, then F1, AUC, input order."""
    recall, f1, auc = (F.round(c, 4) for c in ("recall", "f1", "auc_roc"))
    return metrics.withColumn("__place", F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.desc(recall >= min_recall), F.desc(f1), F.desc_nulls_last(auc), ordinal)
    ))


def select_best(metrics: DataFrame, min_recall: float = D.MIN_RECALL, ordinal: str = "ordinal") -> DataFrame:
    """The chosen model's row: recall gate on 4 digits (ignored if none passes), then F1, then AUC.

    Models below the gate sort after all that pass, so they win only when none does.
    """
    return _ranked(metrics, min_recall, ordinal).where("__place = 1").drop("__place")


def best_by(metrics: DataFrame, metric: str, ordinal: str = "ordinal") -> DataFrame:
    """Ungated winner of one metric at 4 digits, first in input order on ties."""
    best = F.max_by(F.struct("model", metric), F.struct(F.coalesce(F.round(metric, 4), F.lit(-1.0)), -F.col(ordinal)))
    return metrics.agg(best.alias("b")).select("b.model", f"b.{metric}")


def best_by_f1(metrics: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    return best_by(metrics, "f1", ordinal)


def best_by_auc(metrics: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    return best_by(metrics, "auc_roc", ordinal)


def ranked_comparison(metrics: DataFrame, min_recall: float = D.MIN_RECALL, ordinal: str = "ordinal") -> DataFrame:
    """All models in input order, the winner marked, cross-validation as text or N/A, verdict."""
    cv = F.when(
        F.coalesce("cv_f1_mean", F.lit(0.0)) != 0, F.format_string("%.3f±%.3f", "cv_f1_mean", "cv_f1_std")
    ).otherwise("N/A")
    return _ranked(metrics, min_recall, ordinal).select(
        ordinal, "model", "accuracy", "precision", "recall", "f1", "auc_roc", cv.alias("cv_f1"),
        (F.col("__place") == 1).alias("is_best"), S.verdict(F.col("recall") >= min_recall).alias("verdict"),
    ).orderBy(ordinal)


def top_k(df: DataFrame, by: str, k: int = None, tie: str = None, size: bool = False) -> DataFrame:
    """Rows by falling `by` (by |by| with `size`), ties in order of `tie`; the first k with `k`."""
    order = F.desc_nulls_last(F.abs(by) if size else F.col(by))
    out = df.orderBy(order, *([tie] if tie else []))
    return out if k is None else out.limit(k)
