"""Split, folds, scaling and class weights."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep import defaults as D
from upkeep.functions import scalars as S
from upkeep.operators.bounds import bounded
from upkeep.operators.ranks import class_sizes, segment_rows


def split_sizes(sizes: DataFrame, label: str, test_size: float = D.TEST_SIZE) -> DataFrame:
    """Add `n_test` to a table (label, n): ceil(n * test_size) test rows in all.

    The train part is shared out first by largest remainder, equal remainders going to the
    lower label; the test part is what is left. The table has one row per class.
    """
    whole = Window.partitionBy(F.lit(0))
    total = F.sum("n").over(whole)
    train = total - F.ceil(total * F.lit(float(test_size)))
    shared = sizes.withColumn("__share", F.col("n") * train / total)
    shared = shared.withColumn("__whole", F.floor("__share")).withColumn("__train", train)
    over = F.col("__train") - F.sum("__whole").over(whole)
    place = F.row_number().over(whole.orderBy(F.desc(F.col("__share") - F.col("__whole")), label))
    shared = shared.withColumn("__over", over).withColumn("__place", place)
    taken = F.col("__whole") + F.when(F.col("__place") <= F.col("__over"), 1).otherwise(0)
    return shared.withColumn("n_test", (F.col("n") - taken).cast("bigint")).select(*sizes.columns, "n_test")


def stratified_split(
    df: DataFrame, key: str, label: str = D.TARGET, test_size: float = D.TEST_SIZE, seed: int = D.SEED, out: str = "split"
) -> DataFrame:
    """Add 'train' / 'test' with exact class counts; the rows move through no shuffle.

    In each class the rows first in hash order of the key are the test rows. `key` is unique.
    """
    def ranks(sizes):
        return split_sizes(sizes, label, test_size).withColumn("ranks", F.array("n_test"))

    marked = segment_rows(df, key, label, ranks, 1, seed, "__seg")
    return marked.withColumn(out, F.when(F.col("__seg") == 0, "test").otherwise("train")).drop("__seg")


def stratified_folds(
    df: DataFrame, key: str, label: str = D.TARGET, k: int = D.FOLDS, seed: int = D.SEED, out: str = "fold"
) -> DataFrame:
    """Add a fold 0..k-1: consecutive runs in hash order, sizes per class differing by at most 1."""
    def ranks(sizes):
        base, extra = F.floor(F.col("n") / k), F.col("n") % k
        upto = [(base * j + F.least(F.lit(j), extra)).cast("bigint") for j in range(1, k)]
        return sizes.withColumn("ranks", F.array(*upto))

    return segment_rows(df, key, label, ranks, k - 1, seed, out)


def fit_scaler(train: DataFrame, features: list = None) -> DataFrame:
    """(variable, mean, scale): population standard deviation, 1 where it is zero."""
    names = features or D.FEATURES
    entries = F.array(*[
        F.struct(
            F.lit(v).alias("variable"), F.avg(v).alias("mean"),
            F.when(F.stddev_pop(v) == 0, 1.0).otherwise(F.stddev_pop(v)).alias("scale"),
        )
        for v in names
    ])
    return train.agg(entries.alias("e")).select(F.inline("e"))


def scaler_params(scaler: DataFrame) -> DataFrame:
    return scaler.select("variable", "mean", "scale")


def apply_scaler(df: DataFrame, scaler: DataFrame, features: list = None, digits: int = None) -> DataFrame:
    """Replace each feature by its z-score; `digits` rounds it, for engines to agree exactly.

    The parameters are one row and enter the projection as a scalar subquery.
    """
    names = features or D.FEATURES
    moments = [
        F.max(F.when(F.col("variable") == v, F.struct("mean", "scale"))).alias(f"__{i}") for i, v in enumerate(names)
    ]
    out = df.withColumn("__m", scaler.agg(F.struct(*moments).alias("m")).scalar())

    def z(i, v):
        value = (F.col(v) - F.col(f"__m.__{i}.mean")) / F.col(f"__m.__{i}.scale")
        return value if digits is None else S.rounded(value, digits)

    return out.withColumns({v: z(i, v) for i, v in enumerate(names)}).drop("__m")


def class_weights(df: DataFrame, label: str = D.TARGET) -> DataFrame:
    """(label, n, weight): n / (k * n_c), one row per class."""
    whole = Window.partitionBy(F.lit(0))
    sizes = class_sizes(df, label)
    return sizes.withColumn(
        "weight", F.sum("n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n").cast("double"))
    )


def add_class_weight(df: DataFrame, label: str = D.TARGET, out: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(label, F.col("weight").alias(out))
    return df.join(bounded(weights, "classes"), label).select(*df.columns, out)


def weighted(df: DataFrame, balanced: bool, label: str = "label") -> DataFrame:
    """`df` with `weight`: the class weight if `balanced`, else 1."""
    return add_class_weight(df, label) if balanced else df.withColumn("weight", F.lit(1.0))
