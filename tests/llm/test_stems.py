"""A stem that many items and documents begin with, shorter than a window, makes no pairs of them."""

from pyspark.sql import functions as F

from upkeep.llm import decontaminate
from upkeep.llm.common import lowered, words

STEM = "which of the following statements is true about"


def _hits(spark, n):
    docs = spark.createDataFrame([(i, f"{STEM} " + " ".join(f"d{i}x{j}" for j in range(8))) for i in range(n)], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"{STEM} " + " ".join(f"i{i}x{j}" for j in range(8))) for i in range(n)], "item_id long, text string")
    slim = docs.select(F.col("doc_id").alias("__a"), F.lit(0).alias("__b"), lowered(F.col("text")).alias("t"))
    hashed = slim.select("__a", "__b", F.transform(words(F.col("t")), lambda w: F.xxhash64(w)).alias("h"))
    prints = decontaminate._winnowed(decontaminate._with_grams(hashed, 5), 5, 6)
    bench = items.select(F.col("item_id").cast("string").alias("row"), words(lowered(F.col("text"))).alias("own"))
    both = docs.unionByName(items.where("item_id < 3").select((F.col("item_id") + 1000).alias("doc_id"), F.concat(F.lit("before it "), F.col("text")).alias("text")))
    marked = {r["doc_id"] for r in decontaminate.decontaminate(both, items).where("contaminated").collect()}
    assert marked == {1000, 1001, 1002}
    return decontaminate._window_shifts(slim, prints, bench, 10, 5).count()


def test_common_stems_pair_nothing(spark):
    assert _hits(spark, 40) == 0 and _hits(spark, 160) == 0
