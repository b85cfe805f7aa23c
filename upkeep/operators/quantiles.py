"""Exact quantiles with linear interpolation, with no group held in one task.

Three narrow passes, each with map-side combine: (1) KLL sketches, merged in two levels, give a bracket around
each wanted rank; (2) rows are counted between the bracket ends, each stretch cut again into
equal widths, so every rank's cell is known exactly whatever the sketch's error; (3) only the
rows of a wanted cell, about n / 600 000 of a group, are grouped by value and ordered.
`percentile` would keep every distinct value of a group in one task.

Sketches can be stored, one table a batch of new rows, and merged later (`sketches`, `merged`, `sketched_quantiles`).
"""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.operators.bounds import settle

ACCURACY = 4_096  # k of a sketch; its ranks are off by about 2.3 / k ** 0.9 of the rows
SPREAD = 64  # part sketches of a group that the first level leaves
WIDTHS = 256  # equal-width cells between two bracket ends


def per_variable(df: DataFrame, group: list, variables: list, aggs) -> DataFrame:
    """(group..., variable, aggregates...): `aggs(column)` for each variable in one wide aggregate.

    Rows are not multiplied by the number of variables, only the few result rows are.
    """
    entries = F.array(*[F.struct(F.lit(v).alias("variable"), *aggs(F.col(v).cast("double"))) for v in variables])
    rows = df.groupBy(*group).agg(entries.alias("__e")) if group else df.agg(entries.alias("__e"))
    return rows.select(*group, F.inline("__e"))


def long_values(df: DataFrame, ids: list, variables: list) -> DataFrame:
    """One row (ids, variable, value) per reading; null readings are left out."""
    wide = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in variables])
    return wide.unpivot(ids, variables, "variable", "value").where("value IS NOT NULL")


def sketches(long: DataFrame, group: list, value: str = "value", accuracy: int = ACCURACY) -> DataFrame:
    """(group..., sketch): a mergeable sketch of each group's values, at most `SPREAD` part sketches of which meet in one task.

    Rows are sketched where they are; part sketches of tasks whose numbers agree modulo `SPREAD` are merged, then those.
    """
    part = F.pmod(F.spark_partition_id(), F.lit(SPREAD)).alias("__part")
    parts = long.groupBy(*group, part).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), accuracy).alias("sketch"))
    return parts.groupBy(*group).agg(F.kll_merge_agg_double("sketch", accuracy).alias("sketch"))


def merged(tables: list, group: list, accuracy: int = ACCURACY) -> DataFrame:
    """One sketch a group from tables of sketches, for instance one table a day: no row is read again."""
    return reduce(DataFrame.unionByName, tables).groupBy(*group).agg(F.kll_merge_agg_double("sketch", accuracy).alias("sketch"))


def sketched_quantiles(table: DataFrame, group: list, probs: list, names: list) -> DataFrame:
    """(group..., n, names...): rows and approximate quantiles of each sketch."""
    at = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in probs]))
    found = table.select(*group, F.kll_sketch_get_n_double("sketch").alias("n"), at.alias("__q"))
    return found.select(*group, "n", *[F.col("__q")[i].alias(n) for i, n in enumerate(names)])


def _below(n, p):
    return (F.floor((n - 1) * F.lit(float(p))) + 1).cast("bigint")


def _above(n, p):
    return (F.ceil((n - 1) * F.lit(float(p))) + 1).cast("bigint")


def quantiles(
    long: DataFrame, group: list, probs: list, names: list, value: str = "value", method: str = "exact",
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per group with the named quantiles of `value`."""
    if method == "approx":
        return sketched_quantiles(sketches(long, group, value, accuracy), group, probs, names).drop("n")
    if method != "exact":
        raise ValueError("method must be 'exact' or 'approx'")

    slack = 4.6 / accuracy**0.9
    bracket = sorted({min(1.0, max(0.0, p + s)) for p in probs for s in (-slack, slack)})
    long = long.select(*group, F.col(value).alias("__v"))

    def place(table):
        below = sum(((F.get("__s", F.lit(i)) < F.col("__v")).cast("int") for i in range(len(bracket))), F.lit(0))
        lo, hi = F.get("__s", F.col("__at") - 1), F.get("__s", F.col("__at"))
        part = F.least(F.floor(F.try_divide(F.col("__v") - lo, hi - lo) * WIDTHS), F.lit(WIDTHS - 1))
        placed = long.join(table, group).withColumn("__at", below)
        # both parts grow with the value, so cells are in value order; outer stretches are one cell
        cell = (F.col("__at") * WIDTHS + F.coalesce(part, F.lit(0))).cast("int")
        return placed.withColumn("__seg", F.coalesce(cell, F.lit(0)))

    # both are read twice; written, their size is known, and Spark broadcasts them or not by it
    at = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(p) for p in bracket]))
    sketch = settle(sketches(long, group, "__v", accuracy).select(*group, at.alias("__s")))
    segments = place(sketch).groupBy(*group, "__seg").agg(F.count(F.lit(1)).alias("__c"))
    whole, w = Window.partitionBy(*group), Window.partitionBy(*group).orderBy("__seg")
    spots = [f(F.col("__n"), p) for p in probs for f in (_below, _above)]
    wanted = settle(segments.withColumn("__n", F.sum("__c").over(whole))
        .withColumn("__before", F.sum("__c").over(w) - F.col("__c"))
        .withColumn("__ranks", F.array_distinct(F.filter(
            F.transform(F.array(*spots), lambda r: r - F.col("__before")), lambda r: (r >= 1) & (r <= F.col("__c"))
        )))
        .where(F.size("__ranks") > 0)
        .select(*group, "__seg", "__n", "__before", "__ranks"))
    inner = Window.partitionBy(*group, "__seg").orderBy("__v")
    found = (
        place(sketch).join(wanted, [*group, "__seg"])
        .groupBy(*group, "__seg", "__v")
        .agg(F.count(F.lit(1)).alias("__c"))
        .withColumn("__upto", F.sum("__c").over(inner))
        .join(wanted, [*group, "__seg"])
        .withColumn("__hit", F.filter(
            "__ranks", lambda r: (r > F.col("__upto") - F.col("__c")) & (r <= F.col("__upto"))
        ))
        .where(F.size("__hit") > 0)
        .select(*group, "__n", F.explode("__hit").alias("__r"), "__before", "__v")
    )
    table = found.groupBy(*group).agg(
        F.first("__n").alias("__n"),
        F.map_from_entries(F.collect_list(F.struct(F.col("__r") + F.col("__before"), "__v"))).alias("__at"),
    )

    def interpolate(p):
        n = F.col("__n")
        pos = (n - 1) * F.lit(float(p))
        lo, hi = F.element_at("__at", _below(n, p)), F.element_at("__at", _above(n, p))
        return lo + (hi - lo) * (pos - F.floor(pos))

    return table.select(*group, *[interpolate(p).alias(n) for p, n in zip(probs, names)])
