"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws -ln(u) / weight with u from an MD5 of its key, so that a rerun draws the same. A source's target is
met by complete passes over it first; the rest goes to the documents with the least draws, in whole documents, until
the sizes summed in that order reach it. To sum them without a source in one task, draws are cut into ranges of about
ROWS documents each: sizes are added by range, then summed within it.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.common import without, written

ROWS = 5_000  # documents of a source that are sorted in one task, about
EPOCHS = 3  # no source is used more often
MADE = ("size", "source_size", "target", "taken", "draw")
_BLANK = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), _BLANK), "")).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...], epochs: int = EPOCHS) -> DataFrame:
    """`sources` (source, source_size) with `target`.

    Sources by code point, null last, weigh `weights` in turn. Shares of the whole are proportional to weight; what is
    above `epochs` times a source's size is shared again among the others by weight until none is above. The table has
    one row a source; only sums leave it.
    """
    cap = F.col("source_size") * epochs
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1  # one row a source
    rows = written(sources.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(turn, F.lit(len(weights))).cast("int"))), "sources")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:  # each turn caps at least one more source, or ends
        over = F.col("weight") * level >= cap
        r = rows.agg(F.sum(F.when(over, cap)).alias("full"), F.sum(F.when(~over, F.col("weight"))).alias("open")).first()
        if not r["open"] or (total - (r["full"] or 0)) / r["open"] <= level:
            break
        level = (total - (r["full"] or 0)) / r["open"]
    return rows.withColumn("target", F.least(cap.cast("double"), F.col("weight") * level))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", quality: DataFrame | None = None,
        weights: tuple[float, ...] = (1, 2, 3), seed: int = 42) -> DataFrame:
    """`docs` with `size` (words), `source_size`, `target` (of its source), `draw` and `taken` (words the mix takes).

    `quality` is a table (key, weight) of weights above 0; without a row, null and other values count as 1, and of several
    rows the least counts. It meets keys and sizes only, no texts. Taken is a multiple of the size:
    passes over the whole source, plus one for the documents that the rest takes, the last of them if at least half of
    it fits. Ties of draws are broken by key, then by the text's hash; rows that repeat both are taken alike only as far
    as the rest goes. A null text has size 0, a null source is a source, an empty table gives an empty table; columns of
    `docs` named as the new ones are replaced.
    """
    hidden = ("__row", "__of", "__key", "__hash")
    docs = without(docs, *MADE, *hidden).withColumns({
        "__key": F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")), "__hash": F.xxhash64(F.col(f"`{text}`")), "__of": F.col(f"`{source}`")})
    u = (F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), "__key")), 1, 13), 16, 10).cast("double") + 1) / F.lit(float(2**52 + 1))
    slim = docs.select("__key", "__hash", F.col("__of").alias("source"), word_count(F.col(f"`{text}`")).alias("size"))
    weight = F.lit(1.0)
    if quality is not None:
        k, w = quality.columns
        marks = quality.select(F.col(f"`{k}`").cast("string").alias("__key"), F.col(f"`{w}`").cast("double").alias("__w")).where("__w > 0").groupBy("__key").agg(F.min("__w").alias("__w"))
        slim, weight = slim.join(marks, "__key", "left"), F.coalesce("__w", F.lit(1.0))
    slim = written(slim.select("__key", "__hash", "source", "size", (-F.log(u) / weight).alias("draw")), "sizes")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    plan = written(targets(sizes, weights), "targets")
    rest = F.col("target") - F.floor(F.try_divide("target", "source_size")) * F.col("source_size")
    plan = plan.select("source", "source_size", "target", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).alias("epochs"),
                       F.coalesce(rest, F.lit(0.0)).alias("rest"), F.ceil(F.col("rows") / ROWS).alias("ranges"))

    ranged = slim.join(plan, slim["source"].eqNullSafe(plan["source"])).drop(plan["source"]).withColumn(
        "range", F.least(F.floor((1 - F.exp(-F.col("draw"))) * F.col("ranges")), F.col("ranges") - 1))
    before = ranged.groupBy("source", "range").agg(F.sum("size").alias("here")).withColumn(
        "before", F.sum("here").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)))
    place = Window.partitionBy("source", "range").orderBy("draw", "__key", "__hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = before.select(F.col("source").alias("s"), F.col("range").alias("r"), F.coalesce("before", F.lit(0)).alias("before"))
    summed = ranged.join(before, ranged["source"].eqNullSafe(before["s"]) & (F.col("range") == F.col("r")))
    upto = F.col("before") + F.sum("size").over(place)
    extra = ((upto - F.col("size") / 2) <= F.col("rest")).cast("long")
    number = F.row_number().over(Window.partitionBy("__key", "__hash", "source").orderBy("draw", F.desc("taken")))
    found = summed.select("__key", "__hash", "source", "size", "source_size", "target", "draw", ((F.col("epochs") + extra) * F.col("size")).alias("taken"))
    found = written(found.withColumn("__row", number), "taken")

    own = Window.partitionBy("__key", "__hash", "__of").orderBy(F.lit(0))
    again = written(found.where("__row > 1").select("__key", "__hash").distinct(), "again")
    out = [c for c in docs.columns if c not in hidden and c.lower() not in MADE]
    both = docs.withColumn("__row", F.lit(1))
    if not again.isEmpty():
        both = both.join(again, ["__key", "__hash"], "left_anti").unionByName(
            docs.join(again, ["__key", "__hash"], "left_semi").withColumn("__row", F.row_number().over(own)))
    found = found.select(F.col("__key").alias("k"), F.col("__hash").alias("h"), F.col("source").alias("s"), F.col("__row").alias("n"), "size", "source_size", "target", "draw", "taken")
    on = (F.col("__key") == F.col("k")) & (F.col("__hash") == F.col("h")) & F.col("__of").eqNullSafe(F.col("s")) & (F.col("__row") == F.col("n"))
    return both.join(found, on).select(*[F.col(f"`{c}`") for c in out], "size", "source_size", "target", "draw", "taken")
