"""SMOTE: grow every minority class to the majority size with points between neighbours."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep import defaults as D
from upkeep.functions.hashing import digits, draw, unit
from upkeep.operators.bounds import SMALL, settle
from upkeep.operators.neighbours import listed_rows, nearest_neighbours
from upkeep.operators.ranks import class_sizes, ranked

_ROWS_PER_TASK = 4_000_000


def smote(
    df: DataFrame, key: str, features: list = None, label: str = D.TARGET, k: int = D.NEIGHBOURS, seed: int = D.SEED,
    categorical: list = (), **search,
) -> DataFrame:
    """(key, label, features, synthetic, base_key): the rows of `df` and the new ones.

    A new row is base + u * (neighbour - base): base drawn uniformly with replacement from the
    class, neighbour uniformly from its k nearest rows of the class, u uniform in [0, 1).
    Columns in `categorical` copy the base's code instead. Draws are hashes of the row number,
    so a retry or another partitioning gives the same rows. Use on training rows only.
    """
    features = features or D.FEATURES
    spark = df.sparkSession
    sizes = class_sizes(df, label).limit(SMALL + 1).collect()
    if len(sizes) > SMALL:
        raise ValueError(f"{label} has more than {SMALL} values; it is not a class column")
    biggest = max(r["n"] for r in sizes)
    values = [F.col(f).cast("double").alias(f) for f in features]
    kept = df.select(
        F.col(key).cast("string").alias(key), label, *values, F.lit(False).alias("synthetic"), F.lit(None).cast("string").alias("base_key")
    )
    parts = [kept]
    for c, n in sorted((r[label], r["n"]) for r in sizes):
        if n == biggest:
            continue
        if n <= k:
            raise ValueError(f"class {c} has {n} rows; more than k={k} are needed")
        # written once: the steps below read them several times, and would read the other classes with them
        members = settle(df.where(F.col(label) == c).select(F.col(key).cast("string").alias(key), label, *values))
        near = listed_rows(nearest_neighbours(members, key, features, k, **search), k)
        base = ranked(members, key, label, seed, "__row").join(near.withColumnRenamed("key", key), key, "left")
        new = biggest - n
        tasks = max(spark.sparkContext.defaultParallelism, new // _ROWS_PER_TASK)
        h = draw(seed, F.lit("synthetic"), F.lit(c), "id")
        pair = F.pmod(digits(h, 1, 12), F.lit(n * k))
        draws = spark.range(0, new, 1, tasks).select(
            "id", F.floor(pair / k).cast("bigint").alias("__row"), F.pmod(pair, F.lit(k)).cast("int").alias("__pick"),
            unit(h, 13).alias("__u"),
        )
        joined = draws.join(base, "__row").withColumn("__to", F.col("near")[F.col("__pick")]["x"])

        def between(i, f):
            # rows beyond the listed copies of a point have only copies of themselves around
            target = F.coalesce(F.col("__to")[i], F.col(f))
            return F.col(f) if f in categorical else F.col(f) + F.col("__u") * (target - F.col(f))

        parts.append(
            joined.select(
                F.concat_ws("-", F.lit("synthetic"), F.lit(c), "id").alias(key), label,
                *[between(i, f).alias(f) for i, f in enumerate(features)],
                F.lit(True).alias("synthetic"), F.col(key).alias("base_key"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
