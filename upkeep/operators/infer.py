"""Two-sample Student t test between the two classes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upkeep import defaults as D
from upkeep.functions import scalars as S
from upkeep.operators.quantiles import per_variable


def _p_value_udf():
    import pandas as pd

    def tail(t, df):
        """P(|T| > |t|): regularised incomplete beta I_x(df/2, 1/2) by its continued fraction."""
        import math

        if t is None or df is None or math.isnan(t) or math.isnan(df) or df <= 0:
            return None
        a, b, x = df / 2.0, 0.5, df / (df + t * t)
        if x >= 1.0:
            return 1.0
        flip = x > (a + 1) / (a + b + 2)
        if flip:
            a, b, x = b, a, t * t / (df + t * t)
        front = math.exp(
            math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
        ) / a
        tiny = 1e-300
        c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
        d = 1.0 / (d if abs(d) > tiny else tiny)
        h = d
        for m in range(1, 500):
            for num in (
                m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
            ):
                d = 1.0 + num * d
                d = 1.0 / (d if abs(d) > tiny else tiny)
                c = 1.0 + num / c
                c = c if abs(c) > tiny else tiny
                h *= c * d
            if abs(c * d - 1.0) < 1e-15:
                break
        return 1.0 - front * h if flip else front * h

    def p_value(t: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series([tail(a, b) for a, b in zip(t, df)], dtype="float64")

    return F.pandas_udf(p_value, T.DoubleType())


def two_sided_p(t: Column, df: Column) -> Column:
    """p of a t statistic; meant for result rows (one per variable), not for readings."""
    return _p_value_udf()(t, df.cast("double"))


def class_moments(df: DataFrame, features: list, label: str) -> DataFrame:
    """Per variable: count, mean and sample variance of each class, in one wide aggregate."""
    def aggs(value):
        out = []
        for c in (0, 1):
            v = F.when(F.col(label) == c, value)
            out += [F.count(v).alias(f"n{c}"), F.avg(v).alias(f"mean{c}"), F.var_samp(v).alias(f"var{c}")]
        return out

    return per_variable(df, [], features, aggs)


def t_statistics(moments: DataFrame) -> DataFrame:
    """Add equal-variance t (class 0 minus class 1) and its degrees of freedom."""
    dof = F.col("n0") + F.col("n1") - 2
    pooled = S.ratio((F.col("n0") - 1) * F.col("var0") + (F.col("n1") - 1) * F.col("var1"), dof)
    spread = F.sqrt(pooled * (S.ratio(F.lit(1), "n0") + S.ratio(F.lit(1), "n1")))
    return moments.withColumn("df", dof).withColumn("t", S.ratio(F.col("mean0") - F.col("mean1"), spread))


def t_test_by_class(df: DataFrame, features: list = None, label: str = D.TARGET) -> DataFrame:
    """(variable, n0, n1, mean0, mean1, t, df, p, stars)."""
    rows = t_statistics(class_moments(df, features or D.FEATURES, label)).withColumn("p", two_sided_p(F.col("t"), F.col("df")))
    return rows.select("variable", "n0", "n1", "mean0", "mean1", "t", "df", "p", S.significance_stars("p").alias("stars"))
