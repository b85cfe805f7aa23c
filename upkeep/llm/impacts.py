"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Rows are dealt to blocks, and a block is an index of its own: per coordinate the rows in order of their value, cut to
LEVELS segments of quantised values. What a coordinate adds to a score, less the least it adds in the block, is its
impact, never negative; a positive query coordinate reads the segments from the top, a negative one from the bottom.

Segments of all coordinates are processed by falling quantised impact, in strides. After a stride a row's score is
at most what its segments say at their upper ends, plus the stride's floor for each coordinate not yet seen. The
k-th best of exact scores known so far is a lower bound of the k-th best. Rows that cannot reach it are out by proof;
once few remain they are rescored exactly in integers. Without that proof all segments are processed.

Two passes: each query searches one block for a lower bound, then all blocks with it, so that blocks return few rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.cells import block_count, dealt, in_cells, numbered
from upkeep.llm.common import dropped, written

LEVELS = 32  # segments of a coordinate
STRIDES = 4  # steps from the greatest impact to none
ROWS, QUERIES = 16384, 16384  # of a block at most, about
FEW = 64  # so many rows, or a 64th of the block, are rescored without going on
_INDEX = "block int, keys binary, rows binary, codes binary, ranked binary, low binary, high binary, n long, dims long"


def coded(vector: str, scale: int) -> Column:
    """floor(scale * x) of each component as double."""
    return F.transform(F.col(f"`{vector}`"), lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector: str) -> Column:
    """Neither null nor with a null or non-finite component."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce(F.forall(F.col(f"`{vector}`"), finite), F.lit(False))


def _matrix(lists: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Lists as rows of a matrix; shorter ones end in zeros."""
    lists = lists.combine_chunks()
    at = np.asarray(lists.offsets)
    flat, sizes = np.asarray(lists.flatten()), np.diff(at)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(at[:-1] - at[0], sizes)] = flat
    return out


def build_index(rows: DataFrame, blocks: int, dims: int) -> DataFrame:
    """One row a block: its rows by key (null last), their codes, and per coordinate their order and segment bounds. rows: row, key, code."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("row", "ascending")])  # nulls come last
        codes = _matrix(table["code"], dims)
        ranked, low, high = [], [], []
        for d in range(dims):
            order = np.argsort(codes[:, d], kind="stable")
            value = codes[order, d]
            level = ((value - value[0]).astype(np.float64) * LEVELS // (float(value[-1] - value[0]) + 1.0)).astype(np.int64)
            edge = np.flatnonzero(np.append(True, level[1:] != level[:-1]))
            size = np.diff(np.append(edge, len(value)))
            ranked.append(order.astype(np.int32))
            low.append(np.repeat(value[edge], size))
            high.append(np.repeat(value[edge + size - 1], size))
        keys = pa.BufferOutputStream()
        with pa.ipc.new_stream(keys, pa.schema([table.schema.field("key")])) as to:
            to.write_table(table.select(["key"]))
        pack = lambda parts, t: np.array(parts, t).tobytes()
        return pa.table({
            "block": pa.array([table["block"][0].as_py()], pa.int32()), "keys": [keys.getvalue().to_pybytes()], "rows": [np.asarray(table["row"]).astype(np.int64).tobytes()],
            "codes": [codes.tobytes()], "ranked": [pack(ranked, np.int32)], "low": [pack(low, np.int64)], "high": [pack(high, np.int64)],
            "n": [len(codes)], "dims": [dims]})

    return rows.withColumn("block", dealt(F.col("row"), blocks)).groupBy("block").applyInArrow(build, _INDEX)


def best_of_block(block: dict, query: np.ndarray, bound: int | None, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, exact scores) of the block's best k rows that reach `bound`, ties by place; `own` is left out (-1: none)."""
    codes, ranked, low, high = block["codes"], block["ranked"], block["low"], block["high"]
    n = len(codes)
    used = np.flatnonzero(query)
    exact = lambda places: codes[places] @ query
    base, steps = 0, []  # the least that all coordinates add; impacts, rising, and their rows
    for d in used:
        w = int(query[d])
        if w > 0:
            base += w * int(low[d][0])
            steps.append((w * (high[d] - low[d][0]), ranked[d]))
        else:
            base += w * int(high[d][-1])
            steps.append((w * (low[d] - high[d][-1])[::-1], ranked[d][::-1]))
    most = max((int(i[-1]) for i, _ in steps), default=0)
    score, seen = np.zeros(n, np.int64), np.zeros(n, np.int64)
    done = [n] * len(steps)
    alive = np.arange(n)
    for s in range(1, STRIDES + 1):
        floor = most * (STRIDES - s) // STRIDES if s < STRIDES else -1
        for j, (impact, order) in enumerate(steps):
            first = int(np.searchsorted(impact, floor, "right"))
            if first < done[j]:
                at = order[first : done[j]]
                np.add.at(score, at, impact[first : done[j]])
                np.add.at(seen, at, 1)
                done[j] = first
        rest = (len(steps) - seen) * max(floor, 0)
        upper = score + rest + base
        if own >= 0:
            upper[own] = np.iinfo(np.int64).min
        if n - (own >= 0) >= k:
            guess = np.argpartition(upper, n - k)[n - k :]
            worst = int(exact(guess).min())
            bound = worst if bound is None else max(bound, worst)
        alive = np.flatnonzero(upper >= (np.iinfo(np.int64).min + 1 if bound is None else bound))
        if len(alive) <= max(FEW, n // 64):
            break
    scores = exact(alive)
    by = np.lexsort((alive, -scores))[:k]
    alive, scores = alive[by], scores[by]
    reach = scores >= bound if bound is not None else np.ones(len(scores), bool)
    return alive[reach], scores[reach]


def _opened(row: dict) -> dict:
    n, dims = row["n"], row["dims"]
    per = lambda c, t: np.frombuffer(row[c], t).reshape(dims, n)
    return {"codes": np.frombuffer(row["codes"], np.int64).reshape(n, dims), "ranked": per("ranked", np.int32).astype(np.intp), "low": per("low", np.int64), "high": per("high", np.int64),
            "rows": np.frombuffer(row["rows"], np.int64), "keys": pa.ipc.open_stream(row["keys"]).read_all()["key"]}


def _searcher(k: int, keys: pa.DataType):
    """Searches one block for its queries. queries: row, key, code, bound."""

    def search(index: pa.Table, queries: pa.Table) -> pa.Table:
        of, places, scores, names = [], [], [], []
        if index.num_rows and queries.num_rows:
            block = _opened(index.slice(0, 1).to_pylist()[0])
            local = {r: i for i, r in enumerate(block["rows"].tolist())}
            codes = _matrix(queries["code"], block["codes"].shape[1])
            for i, (row, bound) in enumerate(zip(queries["row"].to_pylist(), queries["bound"].to_pylist())):
                at, score = best_of_block(block, codes[i], bound, local.get(row, -1), k)
                of.append(np.full(len(at), i))
                places.append(at)
                scores.append(score)
            names = block["keys"].take(pa.array(np.concatenate(places)))
        of = pa.array(np.concatenate(of) if of else [], pa.int64())
        return pa.table({"query_row": queries["row"].take(of), "query_key": queries["key"].take(of), "key": pa.chunked_array([pa.array([], keys)]) if not len(of) else names,
                         "score": pa.array(np.concatenate(scores) if scores else [], pa.int64())})

    return search


def topk_search(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256) -> DataFrame:
    """(query_<key>, rank, <key>, score): for each row where `is_query`, the k other rows with the greatest inner product of
    the codes floor(scale * x), ties to the smaller key, null keys last; all rows if there are fewer.

    Rows whose vector is null or has a null or non-finite component take no part; a shorter vector ends in zeros. Rows that
    repeat a key are rows of their own, and only the query's own row is left out. Codes whose inner products may not fit
    64 bits raise an error. An empty table gives an empty table; other columns have no effect.
    """
    spark = vectors.sparkSession
    name = lambda c: F.col(f"`{c}`")
    rows = vectors.where(usable(vector)).select(name(key).alias("key"), coded(vector, scale).alias("code"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = written(numbered(rows), "codes")
    most = F.max(F.greatest(F.abs(F.array_max("code")), F.abs(F.array_min("code"))))
    n, asked, dims, most = rows.agg(F.count(F.lit(1)), F.count_if("asks"), F.coalesce(F.max(F.size("code")), F.lit(0)), F.coalesce(most, F.lit(0))).first()
    if dims * most**2 >= 2**61:
        raise ValueError(f"inner products of {dims} codes up to {most} may not fit 64 bits")
    tasks = spark.sparkContext.defaultParallelism
    blocks, parts = block_count(n, ROWS, tasks, 2048), block_count(asked, QUERIES, 1, QUERIES)
    index = written(build_index(rows.select("row", "key", "code"), blocks, max(dims, 1)), "index")
    typed = vectors.select(name(key).alias("key")).schema
    kind = typed["key"].dataType.simpleString()
    arrow = pa.schema(spark.createDataFrame([], typed).toArrow().schema).field("key").type
    search, schema = _searcher(k, arrow), f"query_row long, query_key {kind}, key {kind}, score long"

    asks = rows.where("asks").select("row", "key", "code")
    home = asks.withColumn("bound", F.lit(None).cast("long")).withColumn("block", dealt(F.col("row"), blocks))
    first = index.groupBy("block").cogroup(home.groupBy("block")).applyInArrow(search, schema)
    bounds = first.groupBy("query_row").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bound"))
    asks = written(asks.join(bounds.withColumnRenamed("query_row", "row"), "row", "left").withColumn("part", dealt(F.col("row"), parts)), "asks")
    found = in_cells(index, asks, parts, index, search, schema)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    best = written(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        F.col("query_key").alias(f"query_{key}"), F.col("rank").cast("int").alias("rank"), F.col("key").alias(key), "score"), "best")
    dropped(rows, index, asks)
    return best
