"""Profiles of a labelled readings table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep import defaults as D
from upkeep.functions import scalars as S
from upkeep.operators.columns import by_mode, rules_table
from upkeep.operators.infer import class_moments, t_statistics, two_sided_p
from upkeep.operators.quantiles import long_values, per_variable, quantiles


def dataset_summary(df: DataFrame, label: str = D.TARGET) -> DataFrame:
    """One row: rows, failures, failure %, nulls over all cells."""
    nulls = sum((F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(label), F.lit(0)).alias("failures"), nulls.alias("nulls")
    ).select("total", "failures", S.ratio("failures", "total", 100).alias("failure_pct"), "nulls")


def schema_profile(df: DataFrame) -> DataFrame:
    """(position, column, dtype, n_rows, n_columns, nulls), one row per column."""
    fields = df.dtypes
    entries = F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("column"), F.lit(dtype).alias("dtype"),
            F.count_if(F.col(f"`{name}`").isNull()).alias("nulls"),
        )
        for i, (name, dtype) in enumerate(fields, 1)
    ])
    row = df.agg(F.count(F.lit(1)).alias("n_rows"), entries.alias("e"))
    return row.select("n_rows", F.lit(len(fields)).alias("n_columns"), F.inline("e"))


def preview(df: DataFrame, key: str, columns: list, n: int = 8) -> DataFrame:
    """First n rows in key order; a top-n per task, not a global sort."""
    return df.select(key, *[c for c in columns if c != key]).orderBy(key).limit(n)


def class_distribution(df: DataFrame, label: str = D.TARGET) -> DataFrame:
    counts = df.agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(label), F.lit(0)).cast("bigint").alias("failures"))
    counts = counts.withColumn("normal", F.col("total") - F.col("failures"))
    return counts.select(
        "total", "normal", "failures",
        S.ratio("normal", "total", 100).alias("normal_pct"),
        S.ratio("failures", "total", 100).alias("failure_pct"),
        S.ratio("normal", "failures").alias("imbalance"),
    )


def mode_frequency(df: DataFrame, modes: list = None) -> DataFrame:
    """(mode, n, pct) of all rows; modes without a column are skipped."""
    present = [m for m in (modes or D.MODES) if m in df.columns]
    entries = F.array(*[
        F.struct(F.lit(m).alias("mode"), F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias("n")) for m in present
    ])
    one = df.agg(F.count(F.lit(1)).alias("total"), entries.alias("e"))
    return one.select("total", F.inline("e")).select("mode", "n", S.ratio("n", "total", 100).alias("pct"))


_Q = [0.25, 0.5, 0.75]
_Q_NAMES = ["q1", "median", "q3"]


def class_stats(df: DataFrame, features: list = None, label: str = D.TARGET, method: str = "exact") -> DataFrame:
    """Per feature and class: n, mean, sample std, quartiles."""
    long = long_values(df, [label], features or D.FEATURES)
    group = ["variable", label]
    moments = per_variable(
        df, [label], features or D.FEATURES, lambda v: [F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std")]
    ).where("n > 0")
    quart = quantiles(long, group, _Q, _Q_NAMES, method=method)
    return moments.join(quart, group)


def class_contrast(df: DataFrame, features: list = None, label: str = D.TARGET, method: str = "exact", with_p: bool = True) -> DataFrame:
    """Per feature: both means, their difference, outer quartiles of each class, t test."""
    long = long_values(df, [label], features or D.FEATURES)
    tests = t_statistics(class_moments(df, features or D.FEATURES, label))
    quart = quantiles(long, ["variable", label], [0.25, 0.75], ["q1", "q3"], method=method)
    sides = quart.groupBy("variable").agg(*[
        F.max(F.when(F.col(label) == c, F.col(q))).alias(f"{q}_{name}")
        for q in ("q1", "q3") for c, name in ((0, "normal"), (1, "failure"))
    ])
    out = tests.join(sides, "variable").select(
        "variable",
        F.col("mean0").alias("mean_normal"), F.col("mean1").alias("mean_failure"),
        (F.col("mean1") - F.col("mean0")).alias("delta"),
        "q1_normal", "q1_failure", "q3_normal", "q3_failure", "t", "df",
    )
    if not with_p:
        return out
    return out.withColumn("p", two_sided_p(F.col("t"), F.col("df"))).withColumn("stars", S.significance_stars("p"))


def describe_features(df: DataFrame, features: list = None, method: str = "exact") -> DataFrame:
    """count, mean, std, min, quartiles, max per feature; quartiles are exact by default."""
    long = long_values(df, [], features or D.FEATURES)
    base = per_variable(df, [], features or D.FEATURES, lambda v: [
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
    ])
    quart = quantiles(long, ["variable"], _Q, _Q_NAMES, method=method)
    return base.join(quart, "variable", "left")


def mode_intervals(df: DataFrame, features: list = None, modes: list = None, method: str = "exact") -> DataFrame:
    """Per failure mode and feature: n, quartiles, min, max; modes without rows do not appear."""
    hits = by_mode(df, modes)
    long = long_values(hits, ["mode"], features or D.FEATURES)
    group = ["mode", "variable"]
    base = per_variable(
        hits, ["mode"], features or D.FEATURES, lambda v: [F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max")]
    )
    return base.join(quantiles(long, group, _Q, _Q_NAMES, method=method), group)


def failure_q1_zones(df: DataFrame, features: list = None, label: str = D.TARGET, falling=D.FALLING_RISK, method: str = "exact") -> DataFrame:
    """Per feature: first quartile among failures, and on which side of it the risk lies."""
    long = long_values(df.where(F.col(label) == 1), [], features or D.FEATURES)
    q1 = quantiles(long, ["variable"], [0.25], ["q1"], method=method)
    return q1.select("variable", F.when(F.col("variable").isin(*falling), "<").otherwise(">").alias("direction"), "q1")


def validate_intervals(df: DataFrame, rules: list = None, label: str = D.TARGET, tol: float = 0.05, method: str = "exact") -> DataFrame:
    """Rules checked against the observed first quartile among failures, rounded to 2 digits."""
    rules = rules or D.RISK_RULES
    long = long_values(df.where(F.col(label) == 1), [], [r[0] for r in rules])
    table = rules_table(df.sparkSession, rules)
    q1 = quantiles(long, ["variable"], [0.25], ["q1"], method=method).withColumn("q1", F.round("q1", 2))
    ok = F.when(F.col("direction") == ">", F.col("q1") >= F.col("threshold") * (1 - tol)).otherwise(
        F.col("q1") <= F.col("threshold") * (1 + tol)
    )
    ok = F.coalesce(ok, F.lit(False))  # without failures there is no quartile, and the rule is to be reviewed
    return table.join(q1, "variable", "left").select(
        "variable", "direction", "threshold", "unit", "q1", ok.alias("ok"),
        F.when(ok, D.RULE_OK).otherwise(D.RULE_REVIEW).alias("status"),
        S.ratio(F.abs(F.col("q1") - F.col("threshold")), "threshold", 100).alias("margin_pct"),
    )


def intervals_concordant(validated: DataFrame) -> DataFrame:
    return validated.agg(F.bool_and("ok").alias("concordant"))


def rate_by_category(df: DataFrame, category: str = D.CATEGORY, label: str = D.TARGET) -> DataFrame:
    out = df.groupBy(category).agg(F.sum(label).cast("bigint").alias("failures"), F.count(label).alias("n"))
    return out.withColumn("rate_pct", S.ratio("failures", "n", 100))


def split_report(split: DataFrame, label: str = D.TARGET, by: str = "split") -> DataFrame:
    """Per part: rows, rows of each class and failure %."""
    out = split.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(label) == 0).alias("normal"),
        F.count_if(F.col(label) == 1).alias("failures"),
    )
    return out.withColumn("failure_pct", S.ratio("failures", "n", 100))


def balance_report(balanced: DataFrame, label: str = D.TARGET, synthetic: str = "synthetic") -> DataFrame:
    """Class counts before and after rebalancing, computed from the table that marks new rows."""
    made = F.col(synthetic)
    counts = balanced.groupBy(label).agg(
        F.count_if(~made).alias("before"), F.count(F.lit(1)).alias("after"), F.count_if(made).alias("created")
    )
    totals = balanced.agg(F.struct(F.count_if(~made).alias("b"), F.count(F.lit(1)).alias("a")).alias("t")).scalar()
    return counts.withColumn("__t", totals).select(
        label, "before", S.ratio("before", "__t.b", 100).alias("before_pct"),
        "after", S.ratio("after", "__t.a", 100).alias("after_pct"), "created",
    )


def prep_summary(df: DataFrame, split: DataFrame, balanced: DataFrame, features: list = None, label: str = D.TARGET,
                 test_size: float = D.TEST_SIZE, seed: int = D.SEED, dataset: str = None, scaler_path: str = None) -> DataFrame:
    """One nested record of what the preparation did."""
    def count(part, c):
        return F.count_if((F.col("split") == part) & (F.col(label) == c))

    sizes = split.agg(F.struct(
        F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "test").alias("test"),
        count("train", 0).alias("train_normal"), count("train", 1).alias("train_failures"),
        count("test", 0).alias("test_normal"), count("test", 1).alias("test_failures"),
    ).alias("s"))
    grown = balanced.agg(F.struct(
        F.count_if(F.col(label) == 0).alias("normal"), F.count_if(F.col(label) == 1).alias("failures"),
        F.count_if("synthetic").alias("created"),
    ).alias("b"))
    return df.agg(F.count(F.lit(1)).alias("total")).select(
        F.current_timestamp().alias("generated_at"), F.lit(dataset).cast("string").alias("dataset"), "total",
        F.array(*[F.lit(f) for f in (features or D.FEATURES)]).alias("features"),
        F.lit(float(test_size)).alias("test_size"), F.lit(seed).alias("seed"),
        sizes.scalar().alias("split"), grown.scalar().alias("smote"), F.lit(scaler_path).cast("string").alias("scaler_path"),
    )
