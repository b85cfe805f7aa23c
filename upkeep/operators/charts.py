"""The numbers behind charts: binned where the readings are many, never raw points collected."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep import defaults as D
from upkeep.functions import scalars as S
from upkeep.functions.hashing import draw, unit
from upkeep.operators.bounds import bounded, settle
from upkeep.operators.columns import with_mode_index
from upkeep.operators.infer import t_test_by_class
from upkeep.operators.quantiles import long_values, quantiles


def _bin_of(v, lo, hi, bins):
    """Equal-width bin, consistent with edges lo + i * (hi - lo) / bins; the last bin is closed."""
    step = (hi - lo) / bins
    i = F.least(F.floor((v - lo) / (hi - lo) * bins), F.lit(bins - 1))
    return (
        F.when(v < lo + i * step, i - 1)
        .when((v >= lo + (i + 1) * step) & (i != bins - 1), i + 1)
        .otherwise(i).cast("int")
    )


def histogram(long: DataFrame, group: list, bins: int, few: bool = True) -> DataFrame:
    """Density histogram of `value` per group over the group's own range, empty bins included.

    (group, bin, lo, hi, count, density, mean). A constant group is widened by 0.5 on each side.
    `few` says the groups are features and classes; otherwise their table is written, and Spark
    broadcasts or shuffles it by its size.
    """
    low, high = F.min("value"), F.max("value")
    ranges = (
        long.groupBy(*group).agg(low.alias("__min"), high.alias("__max"), F.count(F.lit(1)).alias("__n"), F.avg("value").alias("mean"))
        .withColumn("__lo", F.when(F.col("__min") == F.col("__max"), F.col("__min") - 0.5).otherwise(F.col("__min")))
        .withColumn("__hi", F.when(F.col("__min") == F.col("__max"), F.col("__max") + 0.5).otherwise(F.col("__max")))
        .select(*group, "__lo", "__hi", "__n", "mean")
    )
    ranges = bounded(ranges, "histogram groups") if few else settle(ranges)
    counts = (
        long.join(ranges, group)
        .withColumn("bin", _bin_of(F.col("value"), F.col("__lo"), F.col("__hi"), bins))
        .groupBy(*group, "bin").agg(F.count(F.lit(1)).alias("count"))
    )
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("__hi") - F.col("__lo")) / bins
    return grid.join(counts, [*group, "bin"], "left").select(
        *group, "bin", (F.col("__lo") + F.col("bin") * width).alias("lo"),
        F.when(F.col("bin") == bins - 1, F.col("__hi")).otherwise(F.col("__lo") + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce("count", F.lit(0)).alias("count"),
        (F.coalesce("count", F.lit(0)) / (F.col("__n") * width)).alias("density"), "mean",
    )


def histogram_by_class(df: DataFrame, features: list = None, label: str = D.TARGET, bins: int = 40, with_p: bool = True) -> DataFrame:
    """Histogram per feature and class, with the class mean and the t-test label of the feature."""
    features = features or D.OPERATING
    out = histogram(long_values(df, [label], features), ["variable", label], bins)
    if not with_p:
        return out
    p = F.col("p")
    label_of = F.when(p < 0.001, D.P_SMALL).otherwise(F.format_string(D.P_FORMAT, p))
    tests = t_test_by_class(df, features, label).select("variable", label_of.alias("p_label"))
    return out.join(tests, "variable")


def histogram_by_category(df: DataFrame, variable: str = "desgaste", category: str = D.CATEGORY, label: str = D.TARGET, bins: int = 30) -> DataFrame:
    """Histogram of one variable among failures, per category."""
    long = long_values(df.where(F.col(label) == 1), [category], [variable])
    return histogram(long, [category], bins, few=False)


def boxplot_stats(df: DataFrame, features: list = None, label: str = D.TARGET, method: str = "exact") -> DataFrame:
    """Per feature and class: quartiles, whiskers at the last data within 1.5 IQR, outlier count."""
    long = long_values(df, [label], features or D.OPERATING)
    group = ["variable", label]
    box = quantiles(long, group, [0.25, 0.5, 0.75], ["q1", "median", "q3"], method=method)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    v, low, high = F.col("value"), F.col("q1") - reach, F.col("q3") + reach
    out = long.join(box, group).groupBy(*group, "q1", "median", "q3").agg(
        F.min(F.when(v >= low, v)).alias("__lo"), F.max(F.when(v <= high, v)).alias("__hi"),
        F.count_if((v < low) | (v > high)).alias("outliers"), F.count(F.lit(1)).alias("n"),
    )
    return out.select(
        *group, "n", "q1", "median", "q3",
        F.least(F.coalesce("__lo", "q1"), "q1").alias("whisker_low"), F.greatest(F.coalesce("__hi", "q3"), "q3").alias("whisker_high"),
        "outliers",
    )


def scatter_bins(df: DataFrame, x: str, y: str, group: str, bins: int = 50) -> DataFrame:
    """(group, bin_x, bin_y, n, mean_x, mean_y): a scatter as counts on a grid over the whole range."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    box = df.agg(F.struct(F.min(a).alias("x0"), F.max(a).alias("x1"), F.min(b).alias("y0"), F.max(b).alias("y1")).alias("b")).scalar()
    placed = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(group, a.alias("__x"), b.alias("__y"), box.alias("__b"))

    def cell(v, lo, hi):
        return F.when(hi > lo, _bin_of(v, lo, hi, bins)).otherwise(0)

    return (
        placed.withColumn("bin_x", cell(F.col("__x"), F.col("__b.x0"), F.col("__b.x1")))
        .withColumn("bin_y", cell(F.col("__y"), F.col("__b.y0"), F.col("__b.y1")))
        .groupBy(group, "bin_x", "bin_y")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("__x").alias("mean_x"), F.avg("__y").alias("mean_y"))
    )


def scatter_by_mode(df: DataFrame, x: str = "desgaste", y: str = "temp_proceso", modes: list = None, bins: int = 50) -> DataFrame:
    return scatter_bins(with_mode_index(df, modes), x, y, "modo_idx", bins)


def scatter_sample(df: DataFrame, key: str, columns: list, fraction: float, seed: int = D.SEED) -> DataFrame:
    """The rows whose key hashes below `fraction`: the same rows on every run."""
    return df.where(unit(draw(seed, key)) < fraction).select(key, *columns)


def metric_table_long(metrics: DataFrame, names: list = None) -> DataFrame:
    """(model, metric, value), with the cross-validation mean and deviation as 0 where missing."""
    cv = {c: F.coalesce(c, F.lit(0.0)) for c in ("cv_f1_mean", "cv_f1_std") if c in metrics.columns}
    wide = metrics.withColumns(cv) if cv else metrics
    return wide.unpivot("model", [*(names or D.BAR_METRICS), *cv], "metric", "value")


def importance_ranked(importance: DataFrame, value: str = "importance") -> DataFrame:
    """Importances falling, rank 1 first, the largest marked; one row per feature and model."""
    by = [c for c in ("model",) if c in importance.columns] or [F.lit(0)]
    w = Window.partitionBy(*by)
    return importance.withColumns({
        "rank": F.row_number().over(w.orderBy(F.desc(value), "variable")),
        "is_max": F.col(value) == F.max(value).over(w),
    })


def best_per_metric(metrics: DataFrame, names: list = None) -> DataFrame:
    """metric_table_long with the best value of each metric marked."""
    long = metrics.unpivot("model", names or D.BAR_METRICS, "metric", "value")
    return long.withColumn("is_best", F.coalesce(F.col("value") == F.max("value").over(Window.partitionBy("metric")), F.lit(False)))


def kpis(summary: DataFrame, best: DataFrame, min_recall: float = D.MIN_RECALL) -> DataFrame:
    """One row from the data set summary and the chosen model's row."""
    top = best.agg(F.first(F.struct("model", "recall")).alias("b")).scalar()
    return summary.withColumn("__b", top).select(
        "total", "failure_pct", F.col("__b.model").alias("best_model"), F.col("__b.recall").alias("best_recall"),
        F.lit(float(min_recall)).alias("target_recall"),
    )
