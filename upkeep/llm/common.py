"""What the operators of this package share: row keys, written tables, Arrow text, hashes."""

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upkeep.operators.bounds import shared_dir

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # the word of the contracts, after A-Z became a-z
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def without(df: DataFrame, *names: str) -> DataFrame:
    """`df` without columns whose names clash, whatever their case, with those an operator makes."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def with_fields(schema: T.StructType, ddl: str) -> T.StructType:
    """A schema and further fields."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])


def keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    """`df` with `__a`, `__b`: 128 bits that name a row by its key and text, nulls included.

    Rows that repeat key and text share them, and what is found for one holds for the other.
    """
    flag = lambda c: F.col(f"`{c}`").isNull()
    return without(df, "__a", "__b").withColumns({
        "__a": F.xxhash64(flag(key), F.col(f"`{key}`"), F.lit("key")),
        "__b": F.xxhash64(flag(text), F.col(f"`{text}`"), F.lit("text")),
    })


def lowered(text: Column) -> Column:
    """A-Z as a-z and nothing else; null is empty. Translating takes long, and ASCII texts do without."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(low: Column) -> Column:
    """The words of lower-case text. Splitting takes a fifth of the time of extracting."""
    return F.array_remove(F.split(low, NOT_WORD), "")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares."""
    folder = shared_dir(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{folder.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """`df` computed once, written to the shared folder and read from there.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps before.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete written tables once everything made from them is written too."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def search(bounds: Column, value: Column, size: int) -> Column:
    """How many of the `size` sorted `bounds` are at most `value`: a binary search in SQL."""
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(max(1, size.bit_length())))])
    at = lambda i: F.get(bounds, i)
    return F.aggregate(steps, F.lit(0), lambda n, s: F.when(at(n + s - 1) <= value, n + s).otherwise(n))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column end to end, and len + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_binary(column.type)):
        column = column.cast(pa.binary())
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batches, column: str, size: int):
    """Parts of Arrow batches with about `size` bytes of text each; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = text_bytes(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last


def grouped(batches, column: str):
    """Rows of sorted batches, one list of dicts for each run of equal values of `column`."""
    run, of = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if run and row[column] != of:
                yield run
                run = []
            of = row[column]
            run.append(row)
    if run:
        yield run


_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of the k values from each position: polynomial, by doubling. Bytes go through a table."""
    if len(values) < k:
        return np.zeros(0, np.uint64)
    part = _TABLE[values] if values.dtype == np.uint8 else values
    power = lambda n: np.uint64(pow(_BASE, n, 2**64))
    whole, done, span = None, 0, 1
    while True:
        if k & span:
            if whole is None:
                whole = part
            else:
                n = len(values) - done - span + 1
                whole = part[:n] * power(done) + whole[span : span + n]
            done += span
        if done == k:
            return mixed(whole)
        part = part[:-span] * power(span) + part[span:]
        span *= 2
