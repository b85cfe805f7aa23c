"""Exact k nearest rows of the same table, without comparing all pairs.

Equal points are merged first, so copies never meet in one task. Distinct points are cut into
cells: a cell with more than `cell_points` of them is split sixteenfold at medians of a sample of
its own, and what is still too full again, so depth and number of cells have no limit. Each point searches its own cell, which bounds
how far its neighbours can be, and then goes down the tree to the cells that its ball reaches, and
only these. The tree steers balance only: any tree gives the same neighbours. Ties go to the smaller key.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.functions.hashing import unit, draw
from upkeep.operators.bounds import settle

CELL_POINTS = 2_000
LEVELS = 4  # binary splits of one cell in one round
SAMPLE = 1_536  # sampled points of a cell that is split
SIDE = 4  # sampled points that each side of a split must have
QUERIES_PER_TASK = 20_000
BLOCK = 100_000  # distances held at once: two such arrays stay in a core's cache
ROOT = 1  # a cell's parent is the cell without its last LEVELS bits


def _grow(cell_points):
    """Splits of one cell from its sample (x, n: the cell's points): axis -1 where a side would get too few."""

    def grow(sample):
        import numpy as np
        import pandas as pd

        x = np.stack(sample["x"].to_numpy())
        axis, at, groups = np.full(2**LEVELS - 1, -1), np.full(2**LEVELS - 1, np.inf), {0: np.arange(len(x))}
        for node in range(2**LEVELS - 1):
            rows = groups.pop(node)
            groups[2 * node + 1], groups[2 * node + 2] = rows, rows[:0]
            if len(rows) < 2 * SIDE or sample["n"].iloc[0] * len(rows) <= cell_points * len(x):
                continue
            for d in np.argsort(x[rows].min(axis=0) - x[rows].max(axis=0), kind="stable"):  # the widest side first
                v = np.sort(x[rows, d])
                cuts = np.unique(v[SIDE - 1 : len(v) - SIDE])  # points up to a cut go left
                cuts = cuts[cuts < v[-SIDE]]
                if len(cuts):
                    axis[node], at[node] = d, cuts[np.argmin(np.abs(np.searchsorted(v, cuts, "right") - len(v) / 2))]
                    left = x[rows, d] <= at[node]
                    groups[2 * node + 1], groups[2 * node + 2] = rows[left], rows[~left]
                    break
        return pd.DataFrame({"cell": [sample["cell"].iloc[0]], "axis": [axis.tolist()], "at": [at.tolist()]})

    return grow


def _step(points: DataFrame) -> DataFrame:
    """Points with their cell's `axis` and `at` (null: not split), one round further down."""
    out = points.withColumn("__n", F.lit(0))
    for _ in range(LEVELS):
        out = out.withColumn("__d", F.get("axis", F.col("__n")))
        right = F.coalesce((F.col("__d") >= 0) & (F.get("x", F.greatest("__d", F.lit(0))) > F.get("at", F.col("__n"))), F.lit(False))
        out = out.withColumn("__n", 2 * F.col("__n") + 1 + right.cast("int"))
    child = F.shiftleft("cell", LEVELS) + F.col("__n") - (2**LEVELS - 1)
    return out.withColumn("cell", F.when(F.col("axis").isNull(), F.col("cell")).otherwise(child)).drop("__n", "__d", "axis", "at")


def split_cells(places: DataFrame, cell_points: int = CELL_POINTS, seed: int = 0):
    """`places` (id, x, ...) with `cell`, and the tables (cell, axis, at) of the rounds of splits."""
    points, rounds = places.withColumn("cell", F.lit(ROOT).cast("long")), []
    while True:
        full = points.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell_points)
        sample = points.select("id", "x", "cell").join(full, "cell").where(unit(draw(seed, F.lit(len(rounds)), "id")) < SAMPLE / F.col("n"))
        splits = settle(sample.select("cell", "x", "n").groupBy("cell").applyInPandas(_grow(cell_points), "cell long, axis array<int>, at array<double>").where("axis[0] >= 0"))
        if splits.isEmpty():  # no cell is too full, or nothing tells its points apart
            return points, rounds
        points = settle(_step(points.join(splits, "cell", "left")).select(*places.columns, "cell"))
        rounds.append(splits)


def _descend(batches):
    """One round down for balls (id, x, radius, own, cell, gaps, axis, at): the cells below that they reach.

    gaps are the distances to the cell's box along each axis; a split the point is not beyond sets its own.
    """
    import numpy as np
    import pandas as pd

    for b in batches:
        x, gaps, axis, at = (np.stack(b[c].to_numpy()) for c in ("x", "gaps", "axis", "at"))
        gaps, radius = gaps.copy(), b["radius"].to_numpy()
        row, node = np.arange(len(b)), np.zeros(len(b), np.int64)
        for _ in range(LEVELS):
            d = axis[row, node]
            split = d >= 0
            away = np.where(split, x[row, np.maximum(d, 0)] - at[row, node], -np.inf)
            over = split.copy()  # the other side is reached too?
            wide = gaps.copy()
            i = np.flatnonzero(split)
            wide[i, d[i]] = np.maximum(wide[i, d[i]], np.abs(away[i]))
            over &= (wide * wide).sum(axis=1) <= radius[row]
            near, far = 2 * node + 1 + (away > 0), 2 * node + 1 + (away <= 0)
            row, node, gaps = np.concatenate([row, row[over]]), np.concatenate([near, far[over]]), np.concatenate([gaps, wide[over]])
        cell = (b["cell"].to_numpy()[row] << LEVELS) + node - (2**LEVELS - 1)
        yield pd.DataFrame({"id": b["id"].to_numpy()[row], "x": b["x"].to_numpy()[row], "radius": radius[row], "own": b["own"].to_numpy()[row], "cell": cell, "gaps": list(gaps)})


def reached_cells(balls: DataFrame, rounds: list, dims: int) -> DataFrame:
    """(id, x, radius, cell): the cells, other than its own, that each ball (id, x, radius, cell) reaches."""
    ids = balls.schema["id"].dataType.simpleString()
    ddl = f"id {ids}, x array<double>, radius double, own long, cell long, gaps array<double>"
    going = balls.select("id", "x", "radius", F.col("cell").alias("own"), F.lit(ROOT).cast("long").alias("cell"), F.array_repeat(F.lit(0.0), dims).alias("gaps"))
    ended = []
    for splits in rounds:
        below = settle(going.join(splits, "cell").mapInPandas(_descend, ddl))
        if splits is not rounds[0]:
            ended.append(going.join(splits, "cell", "left_anti"))
        going = below
    out = going
    for e in ended:
        out = out.unionByName(e)
    return out.where("cell <> own").select("id", "x", "radius", "cell")


def _search(k):
    """A function finding, for each query point, its k + 1 nearest rows among one cell's points, within its `radius` if known.

    Returns flat arrays per query: distances, keys and coordinates, in (distance, key) order.
    """
    def search(queries, points):
        import numpy as np
        import pandas as pd

        radius = np.full(len(queries), np.inf)
        d2, near_keys, near_x = ([[]] * len(queries) for _ in range(3))
        if len(queries) and len(points):
            xs, qs = np.stack(points["x"].to_numpy()), np.stack(queries["x"].to_numpy())
            held = points["keys"].map(len).to_numpy()
            keys = np.concatenate([np.asarray(v, dtype=object) for v in points["keys"]])
            first = np.concatenate([[0], np.cumsum(held)[:-1]])  # where each point's keys start
            place = pd.factorize(keys, sort=True)[0]
            d2, near_keys, near_x = [], [], []
            columns = np.ascontiguousarray(xs.T)
            step = max(1, BLOCK // len(xs))
            for s in range(0, len(qs), step):
                q = qs[s : s + step]
                d, gap = np.zeros((len(q), len(xs))), np.empty((len(q), len(xs)))
                for j in range(q.shape[1]):
                    np.subtract(q[:, j, None], columns[j], out=gap)
                    gap *= gap
                    d += gap
                kth = min(k, len(xs) - 1)
                most = np.partition(d, kth, axis=1)[:, kth]
                if "radius" in queries:
                    most = np.minimum(most, queries["radius"].to_numpy()[s : s + step])
                qi, ci = np.nonzero(d <= most[:, None])
                # one entry per row key of every point that near
                times = held[ci]
                ends = np.cumsum(times)
                at = np.repeat(first[ci] - (ends - times), times) + np.arange(times.sum())
                dist, qi, ci = np.repeat(d[qi, ci], times), np.repeat(qi, times), np.repeat(ci, times)
                order = np.lexsort((place[at], dist, qi))
                starts = np.searchsorted(qi[order], np.arange(len(q)))
                order = order[np.arange(len(order)) - starts[qi[order]] <= k]
                cuts = np.searchsorted(qi[order], np.arange(1, len(q)))
                d2 += np.split(dist[order], cuts)
                near_keys += np.split(keys[at[order]], cuts)
                near_x += [part.ravel() for part in np.split(xs[ci[order]], cuts)]
            radius = np.array([v[-1] if len(v) > k else np.inf for v in d2])
        return pd.DataFrame({"id": queries["id"].to_numpy(), "radius": radius, "d2": d2, "near_keys": near_keys, "near_x": near_x})

    return search


def _near(dims):
    """The flat arrays as one array of (d2, key, x)."""
    return F.transform(
        F.arrays_zip(F.col("d2"), F.col("near_keys"), F.sequence(F.lit(0), F.size("d2") - 1)),
        lambda e: F.struct(e["d2"].alias("d2"), e["near_keys"].alias("key"), F.slice(F.col("near_x"), e["2"] * dims + 1, F.lit(dims)).alias("x")),
    )


def _point(features):
    return F.array(*[F.col(f).cast("double") + F.lit(0.0) for f in features])


def _locations(rows: DataFrame, k: int) -> DataFrame:
    """Distinct points: (x, copies, keys), keys being the k + 1 smallest; id is the smallest key."""
    # the rank filter is applied before the shuffle too, so a point copied everywhere stays small
    w = Window.partitionBy("x").orderBy("key")
    firsts = rows.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k + 1)
    return (
        firsts.groupBy("x").agg(F.sort_array(F.collect_list("key")).alias("keys"))
        .select(F.col("keys")[0].alias("id"), "x", "keys")
    )


def nearest_neighbours(
    df: DataFrame, key: str, features: list, k: int = 5, cell_points: int = CELL_POINTS, seed: int = 0
) -> DataFrame:
    """(id, x, keys, near) per distinct point: its k + 1 nearest rows, its own copies included.

    `near` is ordered by (squared distance, key) with structs (d2, key, x). A row's k neighbours
    are the first k entries of its point's `near` that are not the row itself.
    """
    rows = df.select(F.col(key).alias("key"), _point(features).alias("x"))
    places = settle(_locations(rows, k))
    key_type = dict(df.dtypes)[key]
    search, near = _search(k), _near(len(features)).alias("near")
    out = f"id {key_type}, radius double, d2 array<double>, near_keys array<{key_type}>, near_x array<double>"
    celled, rounds = split_cells(places, cell_points, seed)
    own = celled.groupBy("cell").applyInPandas(
        lambda pdf: search(pdf, pdf).assign(cell=pdf["cell"].to_numpy(), x=pdf["x"].to_numpy(), keys=pdf["keys"].to_numpy()),
        f"{out}, cell long, x array<double>, keys array<{key_type}>",
    )
    if not rounds:
        return own.select("id", "x", "keys", near)
    own = settle(own.select("id", "x", "keys", "cell", "radius", near))
    reached = reached_cells(own.select("id", "x", "radius", "cell"), rounds, len(features))
    # a cell asked by very many points is searched by several tasks
    load = settle(reached.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES_PER_TASK).cast("int").alias("parts")))
    asks = reached.join(load, "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    offers = celled.join(load, "cell").select(
        "x", "keys", F.col("cell").alias("cell"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    more = asks.groupBy("cell", "part").cogroup(offers.groupBy("cell", "part")).applyInPandas(search, out)
    both = own.select("id", "x", "keys", "near").unionByName(more.where(F.size("d2") > 0).select("id", near), allowMissingColumns=True)
    return both.groupBy("id").agg(
        F.first("x", True).alias("x"), F.first("keys", True).alias("keys"), F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k + 1).alias("near"))


def listed_rows(places: DataFrame, k: int) -> DataFrame:
    """(key, near): the k nearest other rows, for the first k + 1 rows of each point.

    Rows not listed are further copies of a point with more than k + 1 of them; all their
    neighbours are copies of themselves (see `unlisted_rows`).
    """
    rows = places.select(F.explode("keys").alias("key"), "near")
    others = F.filter("near", lambda n: n["key"] != F.col("key"))
    return rows.select("key", F.slice(others, 1, k).alias("near"))


def unlisted_rows(df: DataFrame, places: DataFrame, key: str, features: list, k: int) -> DataFrame:
    """(key, near) of the rows of `df` that `listed_rows` leaves out: the k smallest keys of their point are their nearest rows."""
    rows = df.select(F.col(key).alias("key"), _point(features).alias("x"))
    crowded = places.where(F.size("keys") > k).select("x", "keys", "near")
    return rows.join(crowded, "x").where(~F.array_contains("keys", F.col("key"))).select("key", F.slice("near", 1, k).alias("near"))
