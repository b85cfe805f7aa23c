"""Guards for small tables, and places to cut lineage."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SMALL = 10_000


def bounded(df: DataFrame, what: str, most: int = SMALL) -> DataFrame:
    """`df` marked for broadcast, failing the job when it has more than `most` rows.

    The limit keeps an oversized table from being moved; the check then raises, so no row is
    ever dropped silently.
    """
    total = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    message = f"{what}: more than {most} rows, too large to broadcast"
    ok = F.when(F.col("__rows") > most, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))
    checked = df.limit(most + 1).withColumn("__rows", total).where(ok).drop("__rows")
    return F.broadcast(checked)


_own_dir = []


def shared_dir(spark: SparkSession):
    """The folder all executors can write, as the session names it in spark.checkpoint.dir.

    Where none is named, a local master gets a temporary folder and a cluster gets None.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        return None
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="upkeep-"))
    return _own_dir[0]


def new_path(spark: SparkSession) -> str:
    """A path of its own in the shared folder, which a cluster must name in spark.checkpoint.dir."""
    folder = shared_dir(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{folder.rstrip('/')}/upkeep-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute `df` once, write it to the shared folder and read it from there.

    Several readers then do not repeat the work, the lineage is cut, and later scans prune
    columns and know the table's size. A cluster must name the folder in spark.checkpoint.dir.
    """
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """`df` over at least as many tasks as there are cores, if it is large enough, at the cost of a shuffle: for inputs of few files. Runs no job.

    Spark chooses the number by the size it finds, so a task's share does not grow with the input. Rows are dealt out by the hash
    of the columns `by`. Without any they go round in turn, for which Spark first sorts all rows of a task, and spills large ones.
    """
    return df.hint("rebalance", *[F.col(c) for c in by])
