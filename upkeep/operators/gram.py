"""Sums of products of all pairs of columns in one pass: matrices per task, added up as a tree."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = (2048, 32, 1)  # tasks that add up matrices, level by level
_PACKED = "task int, packed binary"


def _pack(parts):
    import numpy as np

    return np.stack(parts).astype(np.float64).tobytes()


def _moments(x, w):
    """For each pair: weight of rows that have both, mean of the first over them, centred products. Columns are shifted first, constant ones to zero."""
    import numpy as np

    has = ~np.isnan(x)
    low, high = np.where(has, x, np.inf).min(axis=0), np.where(has, x, -np.inf).max(axis=0)
    mean = np.where(has, x, 0).sum(axis=0) / np.maximum(has.sum(axis=0), 1)
    shift = np.where(low == high, low, mean)
    z = np.where(has, x - shift, 0.0)
    m = has.astype(np.float64) * w[:, None]
    n = m.T @ has
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = np.where(n > 0, ((z * w[:, None]).T @ has) / n, 0.0)  # of column i over rows that have j
    square = (z * z * w[:, None]).T @ has - n * mean * mean
    both = (z * w[:, None]).T @ z - n * mean * mean.T
    return n, mean + shift[:, None], square, both


def _joined(a, b):
    """Moments of two sets of rows from those of each."""
    import numpy as np

    n = a[0] + b[0]
    with np.errstate(invalid="ignore", divide="ignore"):
        share = np.where(n > 0, b[0] / n, 0.0)
    off = b[1] - a[1]
    cross = a[0] * share
    return n, a[1] + off * share, a[2] + b[2] + off * off * cross, a[3] + b[3] + off * off.T * cross


def gram(df: DataFrame, columns: list, weight: str = None) -> DataFrame:
    """(i, j, n, mean_i, mean_j, square_i, square_j, both): for each pair of columns, over the rows that have both, their weight (count), means, and
    sums of centred squares and products. One scan; a row with a null weight counts nothing; NaN is null.

    Each task keeps one matrix of columns by columns and sends it once; they are added up in levels, so that no task gets all.
    """
    dims = len(columns)
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)], (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"))

    def scan(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        total = None
        for b in batches:
            if b.num_rows:
                x = np.stack([np.asarray(b.column(i).to_numpy(zero_copy_only=False), np.float64) for i in range(dims)], axis=1)
                w = np.nan_to_num(np.asarray(b.column(dims).to_numpy(zero_copy_only=False), np.float64))
                own = _moments(x, w)
                total = own if total is None else _joined(total, own)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([_pack(total)], pa.binary())], ["task", "packed"])

    def add(table):
        import numpy as np
        import pyarrow as pa

        total = None
        for p in table["packed"].to_pylist():
            one = tuple(np.frombuffer(p).reshape(4, dims, dims))
            total = one if total is None else _joined(total, one)
        return pa.table({"task": pa.array([table["task"][0].as_py()], pa.int32()), "packed": pa.array([_pack(total)], pa.binary())})

    parts = values.mapInArrow(scan, _PACKED)
    for tasks in LEVELS:
        parts = parts.withColumn("to", F.pmod("task", F.lit(tasks))).groupBy("to").applyInArrow(add, _PACKED)

    def listed(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for p in b.column(1).to_pylist():
                n, mean, square, both = np.frombuffer(p).reshape(4, dims, dims)
                i, j = (v.ravel() for v in np.indices((dims, dims)))
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (i, j, n.ravel(), mean.ravel(), mean.T.ravel(), square.ravel(), square.T.ravel(), both.ravel())],
                                                 ["i", "j", "n", "mean_i", "mean_j", "square_i", "square_j", "both"])

    return parts.mapInArrow(listed, "i long, j long, n double, mean_i double, mean_j double, square_i double, square_j double, both double")
