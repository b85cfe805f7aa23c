"""Exact ranks in hash order without putting a class into one task.

A window over a two-valued label would be two tasks. Here rows are counted per (class, hash
prefix) with map-side combine, and only that small table is ordered as a whole.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.functions.hashing import digits, draw
from upkeep.operators.bounds import bounded, settle

PREFIX = 4  # hex digits: 65 536 buckets per class


def _hashed(df, key, seed):
    # never null, or the optimiser adds a null check that computes the hash a second time
    bucket = F.coalesce(digits(F.col("__h"), 1, PREFIX).cast("int"), F.lit(0))
    return df.withColumn("__h", draw(seed, key)).withColumn("__b", bucket)


def class_sizes(df: DataFrame, group: str) -> DataFrame:
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))


def _class_cells(slim, group):
    """One row per class: its size and its row count per hash bucket, as a sorted array."""
    cells = slim.groupBy(group, "__b").agg(F.count(F.lit(1)).alias("__n"))
    return cells.groupBy(group).agg(
        F.sum("__n").alias("n"), F.sort_array(F.collect_list(F.struct("__b", "__n"))).alias("__cells")
    )


def _offsets(classes, group, *more):
    """(class, bucket, rows before, rows inside) from the per-class arrays."""
    w = Window.partitionBy(group).orderBy("__b")
    return classes.select(group, *more, F.inline("__cells")).withColumn("__before", F.sum("__n").over(w) - F.col("__n"))


def segment_rows(df: DataFrame, key: str, group: str, ranks, cuts: int, seed, out: str) -> DataFrame:
    """Add `out`: how many of the class's `cuts` cut ranks lie before the row in hash order.

    `ranks` is called with a table (class, n) of one row per class and adds `ranks`: an array of
    `cuts` 1-based ranks, 0 for a cut before the first row. The wide rows are neither shuffled
    nor sorted: the hash of each cut row is found from bucket counts and the one bucket the cut
    falls in, then every row is compared with it. `key` must be unique.
    """
    slim = _hashed(df.select(key, group), key, seed)
    sized = ranks(_class_cells(slim, group))
    at = (
        _offsets(sized, group, "ranks")
        .withColumn("__in", F.array_distinct(F.filter(
            F.transform("ranks", lambda r: r - F.col("__before")), lambda r: (r >= 1) & (r <= F.col("__n"))
        )))
        .where(F.size("__in") > 0)
        .select(F.col(group).alias("__g"), F.col("__b").alias("__at"), "__in")
    )
    at = bounded(at, "cut buckets")
    w = Window.partitionBy(group, "__b").orderBy("__h", key)
    found = (
        slim.join(at, slim[group].eqNullSafe(at["__g"]) & (slim["__b"] == at["__at"])).select(*slim.columns, "__in")
        .withColumn("__r", F.row_number().over(w))
        .where(F.array_contains("__in", F.col("__r").cast("bigint")))
    )
    # a cut of rank 0 has no row and so lies before every row; where ranks repeat, the cut
    # row of the repeats is the class's last, before which nothing changes
    table = found.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("__h", F.col(key).alias("__k")))).alias("__cuts"))
    table = bounded(table.select(F.col(group).alias("__g"), "__cuts"), "classes")
    joined = df.join(table, df[group].eqNullSafe(table["__g"]), "left").withColumn(
        "__me", F.struct(draw(seed, key).alias("__h"), F.col(key).alias("__k"))
    )
    ahead = sum(
        (F.coalesce((F.col("__me") <= F.get("__cuts", F.lit(i))).cast("int"), F.lit(0)) for i in range(cuts)), F.lit(0)
    )
    return joined.withColumn(out, F.lit(cuts) - ahead).select(*df.columns, out)


def ranked(df: DataFrame, key: str, group: str, seed, out: str) -> DataFrame:
    """Add `out`: the 0-based rank of the row inside its class, in hash order of `key`."""
    slim = _hashed(df.select(key, group), key, seed)
    offsets = settle(_offsets(_class_cells(slim, group), group).select(group, "__b", "__before"))  # its size decides how it is joined
    w = Window.partitionBy(group, "__b").orderBy("__h", key)
    return (
        _hashed(df, key, seed).withColumn("__r", F.row_number().over(w))
        .join(offsets, [group, "__b"])
        .withColumn(out, F.col("__before") + F.col("__r") - 1)
        .select(*df.columns, out)
    )
