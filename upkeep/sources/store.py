"""Saving and loading prepared data, models, tables and documents."""

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


VERSIONS, MANIFEST = "versions", "manifests"


def _files(spark, path):
    """The file system of a path and a maker of paths, as Spark itself reaches them."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    return hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _published(spark, path):
    """Numbers of the versions that have a manifest, rising."""
    fs, at = _files(spark, path)
    folder = at(f"{path}/{MANIFEST}")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def publish(spark: SparkSession, path: str, parts: dict, keep: int = 2) -> int:
    """Write all parts of a new version under `path`, then make it the current one; returns its number.

    parts: name -> function that writes the part to the path it is given. Readers go by the manifest with the greatest
    number, and it appears by one rename after all parts are there: a failure before leaves the old version current, and
    what it wrote is removed by the next publication. The `keep` newest versions stay, for readers under way. One
    writer at a time: a manifest of the same number stops the second one.
    """
    fs, at = _files(spark, path)
    done = _published(spark, path)
    number = done[-1] + 1 if done else 1
    folder = f"{path}/{VERSIONS}/{number}"
    fs.delete(at(folder), True)  # of a publication that failed
    for name, write in parts.items():
        write(f"{folder}/{name}")
    draft, final = at(f"{path}/{MANIFEST}/.{number}.draft"), at(f"{path}/{MANIFEST}/{number}.json")
    fs.mkdirs(at(f"{path}/{MANIFEST}"))
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps({"version": number, "parts": sorted(parts)}).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        raise FileExistsError(f"version {number} of {path} was published meanwhile")
    for old in done[: max(0, len(done) + 1 - keep)]:
        fs.delete(at(f"{path}/{MANIFEST}/{old}.json"), True)
        fs.delete(at(f"{path}/{VERSIONS}/{old}"), True)
    return number


def current(spark: SparkSession, path: str) -> str:
    """The folder of the current version; FileNotFoundError when there is none."""
    done = _published(spark, path)
    if not done:
        raise FileNotFoundError(path)
    return f"{path}/{VERSIONS}/{done[-1]}"


def write_processed(path: str, balanced_train: DataFrame, scaled_test: DataFrame, features: list) -> int:
    """Parquet: `train`, `test` and the ordered feature names, published together as one version."""
    spark = balanced_train.sparkSession
    names = spark.createDataFrame([(list(features),)], "features array<string>").coalesce(1)
    return publish(spark, path, {n: df.write.parquet for n, df in (("train", balanced_train), ("test", scaled_test), ("features", names))})


def read_processed(spark: SparkSession, path: str) -> tuple:
    """(train, test, features) of the current version."""
    folder = current(spark, path)
    return spark.read.parquet(f"{folder}/train"), spark.read.parquet(f"{folder}/test"), spark.read.parquet(f"{folder}/features").first()["features"]


def save_model(model, path: str) -> int:
    """Publish a model with its scaler (see `train.with_scaler`) as a new version."""
    if not isinstance(model, PipelineModel):
        model = PipelineModel(stages=[model])
    return publish(SparkSession.active(), path, {"model": lambda to: model.write().save(to)})


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    """The current version of a saved model; FileNotFoundError when there is none."""
    return PipelineModel.load(f"{current(spark, path)}/model")


def write_stats_csv(df: DataFrame, path: str) -> None:
    """A result table as CSV with header, in one file; meant for tables of a row per feature or model."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_json(record: DataFrame, path: str) -> int:
    """One JSON document per row, nulls kept, published as a new version."""
    doc = record.select(F.to_json(F.struct(*record.columns), {"ignoreNullFields": "false"}).alias("value"))
    return publish(record.sparkSession, path, {"documents": doc.coalesce(1).write.text})


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """The current documents written by `write_json`, with an explicit schema; FileNotFoundError when missing."""
    docs = spark.read.text(f"{current(spark, path)}/documents")
    return docs.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
