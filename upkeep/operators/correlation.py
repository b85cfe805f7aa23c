"""Pearson correlations; a constant column gives null, pairs with a null on a side are left out."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep import defaults as D
from upkeep.functions import scalars as S
from upkeep.operators.gram import gram


def safe_corr(x: str, y: str) -> Column:
    """Pearson r as an aggregate; null, not an error, when a side does not vary."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    a, b = F.when(b.isNotNull(), a), F.when(F.col(x).isNotNull(), b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def corr_with_target(df: DataFrame, features: list = None, label: str = D.TARGET) -> DataFrame:
    """(variable, r, abs_r), one aggregate for all features; sorted by size, largest first."""
    entries = F.array(*[F.struct(F.lit(v).alias("variable"), safe_corr(v, label).alias("r")) for v in (features or D.FEATURES)])
    rows = df.agg(entries.alias("e")).select(F.inline("e")).withColumn("abs_r", F.abs("r"))
    return rows.orderBy(F.desc_nulls_last("abs_r"), "variable")


def corr_with_target_signed(df: DataFrame, features: list = None, label: str = D.TARGET) -> DataFrame:
    return corr_with_target(df, features or D.OPERATING, label).select("variable", "r").orderBy(F.asc_nulls_last("r"), "variable")


def _all_pairs(df, names):
    """(i, j, x, y, r) of all pairs from one scan, the diagonal included: 1 where a column varies."""
    name = F.array(*[F.lit(n) for n in names])
    r = F.try_divide("both", F.sqrt("square_i") * F.sqrt("square_j"))
    r = F.when(F.col("i") == F.col("j"), F.when(F.col("square_i") > 0, 1.0)).otherwise(r)
    return gram(df, names).select("i", "j", F.get(name, F.col("i").cast("int")).alias("x"), F.get(name, F.col("j").cast("int")).alias("y"), r.alias("r"))


def corr_matrix(df: DataFrame, features: list = None, wide: bool = False) -> DataFrame:
    """All pairs, long (x, y, r) or wide (x, one column per feature)."""
    names = features or D.FEATURES
    long = _all_pairs(df, names).select("x", "y", "r")
    if not wide:
        return long
    return long.groupBy("x").agg(*[F.max(F.when(F.col("y") == n, F.col("r"))).alias(n) for n in names])


def corr_pairs(df: DataFrame, features: list = None, min_abs: float = 0.3) -> DataFrame:
    """Pairs with |r| above `min_abs`, with a strength word."""
    strong = _all_pairs(df, features or D.FEATURES).where((F.col("i") < F.col("j")) & (F.abs("r") > min_abs))
    return strong.select("x", "y", "r", F.coalesce(S.corr_strength("r"), F.lit(D.MODERATE)).alias("strength"))


def top_corr(df: DataFrame, pair: tuple, features: list = None, label: str = D.TARGET) -> DataFrame:
    """One row: the feature most correlated with the label, and the r of one named pair."""
    best = corr_with_target(df, features, label).agg(
        F.max_by("variable", "abs_r").alias("variable"), F.max("abs_r").alias("abs_r")
    )
    named = df.agg(safe_corr(*pair).alias("r")).scalar()
    return best.select("variable", "abs_r", F.lit(pair[0]).alias("pair_x"), F.lit(pair[1]).alias("pair_y"), named.alias("pair_r"))
