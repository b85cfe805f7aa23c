"""Stateless operators on a stream of readings: the batch functions, with a file source and sink.

Both are row-wise, so they need no watermark and no state; exactly-once comes from the sink's
checkpoint.
"""

from pyspark.sql import DataFrame, SparkSession

from upkeep.operators.columns import flag_risk_zone
from upkeep.operators.train import score


def stream_readings(spark: SparkSession, path: str, schema, files_per_trigger: int = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def score_stream(model, stream: DataFrame, keep: list) -> DataFrame:
    """Class and failure probability per arriving row."""
    return score(model, stream, keep)


def risk_stream(stream: DataFrame, rules: list = None) -> DataFrame:
    """Risk-zone flags per arriving row."""
    return flag_risk_zone(stream, rules)


def write_stream(stream: DataFrame, path: str, checkpoint: str, wait: bool = True):
    """Append to Parquet what is available, then stop; run again to pick up new files."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query
