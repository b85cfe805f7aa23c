"""A prefix scan: running totals over an ordered value, in one range-partitioned pass."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.operators.bounds import settle


def _scanner(group, sums, names):
    """Totals of what stands before each row in its partition and group, and the row before; state is carried over batches."""

    def scan(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last, base, before = None, dict.fromkeys(sums, 0), dict.fromkeys(sums)
        for b in batches:
            if not b.num_rows:
                continue
            of = b.column(names.index(group))
            same = np.asarray(of.slice(1).to_pandas() == of.slice(0, len(of) - 1).to_pandas(), dtype=bool) | np.asarray(of.slice(1).is_null()) & np.asarray(of.slice(0, len(of) - 1).is_null())
            fresh = np.append(last is None or of[0] != last, ~same)
            start = np.maximum.accumulate(np.where(fresh, np.arange(len(of)), 0))
            made = []
            for s in sums:
                v = np.asarray(b.column(names.index(s)))
                total = np.concatenate([[0], np.cumsum(v)[:-1]])
                carried = base[s] if not fresh[0] else 0
                below = total - total[start] + np.where(start == 0, carried, 0)
                previous = np.concatenate([[before[s] or 0], v[:-1]])
                made += [pa.array(below), pa.array(previous, mask=fresh)]
                base[s], before[s] = int(below[-1] + v[-1]), int(v[-1])
            last = of[len(of) - 1]
            yield pa.RecordBatch.from_arrays([*b.columns, *made, pa.array(np.full(len(of), part, np.int32))], [*names, *[f"{s}_{e}" for s in sums for e in ("below", "before")], "__part"])

    return scan


def prefix_scan(df: DataFrame, group: str, value: str, sums: list) -> DataFrame:
    """Totals over all smaller values of the row's group, and the row before.

    `df` has one row per (group, value) with whole numbers in `sums`. Adds `<s>_below` and `<s>_before` (null on a group's first row); null
    values come first. Rows are dealt out by ranges of (group, value), as many as their size asks for, so one group's rows may fill any number of
    tasks; each task adds up its own, and one row a task and group is added up over tasks. The result is written once.
    """
    names = df.columns
    more = ", ".join(f"{s}_{e} bigint" for s in sums for e in ("below", "before"))
    types = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
    ranged = df.repartitionByRange(group, value).sortWithinPartitions(group, value)
    parts = settle(ranged.mapInArrow(_scanner(group, sums, names), f"{types}, {more}, __part int"))
    w = Window.partitionBy(group).orderBy("__part")
    heads = parts.groupBy(group, "__part").agg(*[F.sum(s).alias(s) for s in sums], *[F.max_by(s, F.struct(F.col(value).isNotNull(), value)).alias(f"{s}_last") for s in sums])
    heads = heads.select(F.col(group).alias("__g"), F.col("__part").alias("__p"), *[(F.sum(s).over(w) - F.col(s)).alias(f"__{s}") for s in sums], *[F.lag(f"{s}_last").over(w).alias(f"__{s}_last") for s in sums])
    joined = parts.join(settle(heads), F.col(group).eqNullSafe(F.col("__g")) & (F.col("__part") == F.col("__p")))
    return joined.select(*names, *[c for s in sums for c in ((F.col(f"{s}_below") + F.col(f"__{s}")).alias(f"{s}_below"), F.coalesce(f"{s}_before", f"__{s}_last").alias(f"{s}_before"))])
