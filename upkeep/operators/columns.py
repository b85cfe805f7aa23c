"""Columns added to, and rows chosen from, a readings table."""

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep import defaults as D
from upkeep.functions import scalars as S
from upkeep.operators.bounds import settle
from upkeep.operators.running import prefix_scan


def rename_columns(df: DataFrame, names: dict = None) -> DataFrame:
    """Rename by a fixed map; names that are absent pass."""
    return df.withColumnsRenamed(names or D.RENAMES)


def require_columns(df: DataFrame, columns: list) -> DataFrame:
    """Raise ValueError listing the missing names; runs no job."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def category_codes(df: DataFrame, column: str = D.CATEGORY) -> DataFrame:
    """(category, code): codes 0..k-1 in sorted order of the category, a prefix scan over its levels, however many."""
    levels = df.select(column).where(F.col(column).isNotNull()).distinct()
    scan = prefix_scan(levels.select(column, F.lit(0).alias("__all"), F.lit(1).cast("bigint").alias("__n")), "__all", column, ["__n"])
    return scan.select(column, F.col("__n_below").cast("int").alias("code"))


def encode_category(df: DataFrame, column: str = D.CATEGORY, out: str = D.CATEGORY_CODE) -> DataFrame:
    """Add the sorted integer code of a category column.

    The codes are a written table, so Spark knows their size: it broadcasts a small one and
    shuffles a large one, splitting a hot category by its own skew handling.
    """
    codes = settle(category_codes(df, column).withColumnRenamed("code", out))
    return df.join(codes, column, "left").select(*df.columns, out)


def add_temp_diff(df: DataFrame, air="temp_aire", process="temp_proceso", out="diff_temp") -> DataFrame:
    return df.withColumn(out, S.temp_diff(air, process))


def add_power_w(df: DataFrame, torque="torque", speed="vel_rotacion", out="potencia_w") -> DataFrame:
    return df.withColumn(out, S.power_w(torque, speed))


def select_features(df: DataFrame, key: str, features: list = None, label: str = D.TARGET, as_vector=True) -> DataFrame:
    """(key, features, label): features as an ML vector, a null or NaN failing the job, or as array<double>.

    Spark ML's assembler is not deterministic to Spark, so that a filter on the key would not be applied before it; this vector is plain.
    """
    features = features or D.FEATURES
    require_columns(df, [key, label, *features])
    values = F.array(*[F.col(c).cast("double").alias(c) for c in features])
    target = F.col(label).cast("double").alias("label")
    if not as_vector:
        return df.select(key, values.alias("features"), target)
    missing = reduce(Column.__or__, [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in features])
    message = F.lit(f"null or NaN in one of the features {', '.join(features)}")
    whole = F.when(missing, F.raise_error(message).cast("array<double>")).otherwise(values)
    return df.select(key, array_to_vector(whole).alias("features"), target)


def by_class(df: DataFrame, value: int, label: str = D.TARGET) -> DataFrame:
    return df.where(F.col(label) == value)


def by_mode(df: DataFrame, modes: list = None) -> DataFrame:
    """One row per reading and mode flag set; modes without a column are skipped."""
    present = [m for m in (modes or D.MODES) if m in df.columns]
    if not present:
        return df.select(F.lit("").alias("mode"), *df.columns).limit(0)
    hits = F.filter(F.array(*[F.when(F.col(m) == 1, F.lit(m)) for m in present]), lambda m: m.isNotNull())
    any_set = reduce(Column.__or__, [F.col(m) == 1 for m in present])  # reaches the scan
    return df.where(any_set).select(F.explode(hits).alias("mode"), *df.columns)


def with_mode_index(df: DataFrame, modes: list = None, out: str = "modo_idx") -> DataFrame:
    present = [m for m in (modes or D.MODES)]
    return df.withColumn(out, S.failure_mode_index(present))


def rules_table(spark, rules: list = None) -> DataFrame:
    """(variable, direction, threshold, unit)."""
    return spark.createDataFrame(
        rules or D.RISK_RULES, "variable string, direction string, threshold double, unit string"
    )


def flag_risk_zone(df: DataFrame, rules: list = None) -> DataFrame:
    """Add `<variable>_risk` per rule and `risk_count`; row-wise, so it also runs on a stream."""
    rules = rules or D.RISK_RULES
    flags = {}
    for variable, direction, threshold, _unit in rules:
        value = F.col(variable)
        flags[f"{variable}_risk"] = value > threshold if direction == ">" else value < threshold
    count = sum((F.coalesce(f.cast("int"), F.lit(0)) for f in flags.values()), F.lit(0))
    return df.withColumns({**flags, "risk_count": count})
