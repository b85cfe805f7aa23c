"""From raw documents to a training mix: each stage's rows are written and read again as the next one's."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.llm import decontaminate, mixing, neardup, quality, suffix
from upkeep.llm.common import written
from upkeep.llm.queries import held_out, table, weights

REPEAT_BYTES = 256  # shorter than the query's 400, for passages of over 50 words


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more stay."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return quality.score_quality(docs, model).where("predicted = 1").drop("score", "predicted")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return neardup.one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in several places go from all of them; every document stays, with what is left of whole letters."""
    out = suffix.suffix_dedup(docs, min_bytes=REPEAT_BYTES, whole_letters=True)
    cut = F.col("n_removed") > 0
    out = out.withColumn("text", F.when(cut, F.col("kept").cast("string")).otherwise(F.col("text")))
    return out.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars"))).drop(*suffix.MADE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    out = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return out.where(~F.col("contaminated")).drop(*decontaminate.MADE)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the mix takes words, with how many; those without any words stay."""
    return mixing.mix(docs, quality=weights(spark, sf_dir)).where("taken > 0 OR size = 0")


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mixing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
