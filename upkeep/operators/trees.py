"""Fitted trees as tables: nodes, leaf boxes, scores from them, counts and importances from data, and a forest that knows its bags.

A node table has one row a node: (tree, node, level, path, feature, threshold, left, right, n0, n1, p). `path` is the
way from the root in L and R; a leaf has feature -1. Its size is bounded by trees * 2 ** (depth + 1), whatever the data's.
"""

import math
from dataclasses import dataclass
from fractions import Fraction

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upkeep import defaults as D
from upkeep.functions import md5
from upkeep.functions.hashing import draw, unit
from upkeep.operators import forest
from upkeep.operators.bounds import new_path, settle

MAX_BINS = 256  # candidate splits per feature; Spark's default of 32 is coarse for sensors
_NODES = ("tree int, node int, level int, path string, feature int, threshold double, left int, right int, n0 double, n1 double, p double, "
          "parents array<int>, lower array<double>, upper array<double>")
# Cumulative Poisson(1) probabilities of 0..7 draws.
POISSON = (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183, 0.9999167588507119, 0.9999897508033253)
POISSON_48 = tuple(math.ceil(Fraction(p) * 2**48) for p in POISSON)  # of the first 48 bits of a hash
PIECE = 16_384  # rows hashed at once: what a hash works on stays in cache


def _placed(dims):
    """Adds to one tree's nodes where they are: level, path, the nodes above (itself last) and the box of readings that reach them."""

    def place(nodes):
        nodes = nodes.sort_values("node").reset_index(drop=True)  # a parent comes before its children
        inf = float("inf")
        at = {int(nodes["node"].iloc[0]): ("", [int(nodes["node"].iloc[0])], [-inf] * dims, [inf] * dims)}
        for r in nodes.itertuples():
            path, above, lower, upper = at[r.node]
            if r.feature >= 0:
                low, high = list(lower), list(upper)
                high[r.feature] = min(high[r.feature], r.threshold)
                low[r.feature] = max(low[r.feature], r.threshold)
                at[r.left] = (path + "L", [*above, r.left], lower, high)
                at[r.right] = (path + "R", [*above, r.right], low, upper)
        ways = [at[n] for n in nodes["node"]]
        nodes["level"] = [len(w[0]) for w in ways]
        for i, c in enumerate(("path", "parents", "lower", "upper")):
            nodes[c] = [w[i] for w in ways]
        return nodes[[c.split()[0] for c in _NODES.split(", ")]]

    return place


def _table(data: DataFrame, dims: int) -> DataFrame:
    """Node rows of saved models, completed and written."""
    split = F.col("split.leftCategoriesOrThreshold")
    categorical = F.when(F.col("split.numCategories") > 0, F.raise_error(F.lit("splits by category have no threshold")).cast("int"))
    n0, n1 = (F.get("impurityStats", F.lit(i)) for i in (0, 1))
    flat = data.select(
        "tree", F.col("id").alias("node"), F.coalesce(categorical, F.when(F.col("leftChild") >= 0, F.col("split.featureIndex")).otherwise(-1)).cast("int").alias("feature"),
        F.get(split, F.lit(0)).alias("threshold"), F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
        n0.alias("n0"), n1.alias("n1"), F.try_divide(n1, n0 + n1).alias("p"))
    return settle(flat.groupBy("tree").applyInPandas(_placed(dims), _NODES))


def tree_nodes(model) -> DataFrame:
    """The node table of a fitted tree or forest, read from its saved form."""
    spark = SparkSession.active()
    path = new_path(spark)
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    data = data.select(F.col("treeID").alias("tree"), "nodeData.*") if "nodeData" in data.columns else data.withColumn("tree", F.lit(0))
    return _table(data, model.numFeatures)


def leaf_boxes(nodes: DataFrame) -> DataFrame:
    """(tree, node, path, lower, upper, p): a reading x is in the box with lower < x <= upper in every feature, in one box of each tree.

    This is the whole model for an engine that knows joins only: join rows and boxes on those intervals, average p over trees.
    """
    return nodes.where("feature < 0").select("tree", "node", "path", "lower", "upper", "p")


def reached(rows: DataFrame, nodes: DataFrame, keep: list, features: str = "features", when: Column = None) -> DataFrame:
    """(keep..., tree, node, p): the leaf of each row in each tree; `when` (over the rows' columns and `tree`) picks pairs.

    `features` is an array<double>; a null reading goes right. The table is packed to one row a tree and broadcast, which its bound by
    the fit's parameters allows; a row walks down by array lookups in one stage of generated code.
    """
    own = F.sort_array(F.collect_list(F.struct("node", "feature", "threshold", "left", "right", "p")))
    packed = nodes.groupBy("tree").agg(own.alias("t")).select("tree", *[F.col(f"t.{c}").alias(f"__{c}") for c in ("feature", "threshold", "left", "right", "p")])
    steps, trees = nodes.agg(F.max("level"), F.max("tree")).first()
    pairs = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees))))
    if when is not None:
        pairs = pairs.where(when)
    out = pairs.join(F.broadcast(packed), "tree").withColumn("node", F.lit(0))
    for _ in range(steps):
        out = out.withColumn("__f", F.get("__feature", F.col("node")))
        left = F.coalesce(F.get(features, F.greatest("__f", F.lit(0))) <= F.get("__threshold", F.col("node")), F.lit(False))
        out = out.withColumn("node", F.when(F.col("__f") < 0, F.col("node")).when(left, F.get("__left", F.col("node"))).otherwise(F.get("__right", F.col("node"))))
    return out.select(*keep, "tree", "node", F.get("__p", F.col("node")).alias("p"))


def _walks(nodes: DataFrame):
    """A function giving, for readings (rows by features), each tree's p of the leaf they reach; a missing reading goes right.
    `chosen`, from a tree's number to places of rows, leaves out the other rows of that tree.

    It carries the node table, whose size the fit's parameters bound.
    """
    import numpy as np

    ways = []
    for _, t in nodes.select("tree", "node", "level", "feature", "threshold", "left", "right", "p").toPandas().sort_values(["tree", "node"]).groupby("tree"):
        leaf, own = t["feature"].to_numpy() < 0, np.arange(len(t))
        below = np.stack([np.where(leaf, own, t[c].to_numpy()) for c in ("left", "right")], axis=1).ravel().astype(np.int64)
        ways.append((int(t["level"].max()), np.where(leaf, 0, t["feature"]).astype(np.int64), np.where(leaf, np.inf, t["threshold"]).astype(np.float64), below, t["p"].to_numpy(np.float64)))

    def walk(x, chosen=None):
        flat, first = x.ravel(), np.arange(len(x), dtype=np.int64) * x.shape[1]
        for tree, (steps, feature, threshold, below, p) in enumerate(ways):
            at = first if chosen is None else first.take(chosen(tree), mode="clip")
            node = np.zeros(len(at), np.int64)
            for _ in range(steps):
                near = flat.take(feature.take(node, mode="clip") + at, mode="clip") <= threshold.take(node, mode="clip")
                node = below.take(2 * node + ~near, mode="clip")
            yield p.take(node, mode="clip")

    return walk


def _readings(rows: DataFrame, nodes: DataFrame, features: str):
    """Columns x0, x1, ... of the features that any split reads, one at least, and a function that stacks them."""
    dims = max((nodes.agg(F.max("feature")).first()[0] or 0) + 1, 1)

    def stacked(batch):
        import numpy as np

        return np.stack([np.asarray(batch.column(f"__x{i}").to_numpy(zero_copy_only=False), np.float64) for i in range(dims)], axis=1)

    return [F.get(features, F.lit(i)).cast("double").alias(f"__x{i}") for i in range(dims)], stacked


def score_nodes(nodes: DataFrame, rows: DataFrame, keep: list, features: str = "features") -> DataFrame:
    """(keep..., prediction, probability): the mean over trees of the leaf's share of class 1, row by row without a shuffle."""
    walk, (values, stacked) = _walks(nodes), _readings(rows, nodes, features)

    def scored(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                total, trees = np.zeros(b.num_rows), 0
                for p in walk(stacked(b)):
                    total += p
                    trees += 1
                mean = total / trees
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array((mean > 0.5).astype(np.int32)), pa.array(mean)], [*keep, "prediction", "probability"])

    out = T.StructType([*[rows.schema[c] for c in keep], T.StructField("prediction", T.IntegerType()), T.StructField("probability", T.DoubleType())])
    return rows.select(*keep, *values).mapInArrow(scored, out)


def node_counts(nodes: DataFrame, pairs: DataFrame, label: str = "label", weight: str = "weight") -> DataFrame:
    """(tree, node, c0, c1): weighted class counts of every node, counted at the leaves in one pass and added up the paths."""
    sums = [F.sum(F.when(F.col(label) == c, F.col(weight)).otherwise(0.0)).alias(f"c{c}") for c in (0, 1)]
    leaves = pairs.groupBy("tree", "node").agg(*sums)
    ways = nodes.select("tree", "node", F.explode("parents").alias("above"))
    return leaves.join(ways, ["tree", "node"]).groupBy("tree", F.col("above").alias("node")).agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))


def importances(nodes: DataFrame, counts: DataFrame, names: list) -> DataFrame:
    """(rank, variable, importance) from counts (tree, node, c0, c1): what splits lower the Gini impurity by, weighted by their
    rows, shares within each tree, averaged over trees."""
    n = F.col("c0") + F.col("c1")
    lost = n - F.try_divide(F.col("c0") * F.col("c0") + F.col("c1") * F.col("c1"), n)  # rows times impurity
    each = counts.select("tree", "node", F.coalesce(lost, F.lit(0.0)).alias("lost"))
    side = lambda c: each.select("tree", F.col("node").alias(c), F.col("lost").alias(f"lost_{c}"))
    gains = nodes.where("feature >= 0").join(each, ["tree", "node"]).join(side("left"), ["tree", "left"]).join(side("right"), ["tree", "right"])
    gains = gains.groupBy("tree", "feature").agg(F.sum(F.col("lost") - F.col("lost_left") - F.col("lost_right")).alias("gain"))
    shares = gains.withColumn("share", F.try_divide("gain", F.sum("gain").over(Window.partitionBy("tree")))).groupBy("feature").agg(F.sum("share").alias("share"))
    named = nodes.sparkSession.createDataFrame(list(enumerate(names)), "feature int, variable string").join(shares, "feature", "left")
    whole = Window.partitionBy(F.lit(0))  # one row a feature
    out = named.select("variable", F.coalesce(F.try_divide(F.col("share"), F.sum("share").over(whole)), F.lit(0.0)).alias("importance"))
    return out.select(F.row_number().over(Window.orderBy(F.desc("importance"), "variable")).alias("rank"), "variable", "importance")


def bag_count(seed: int, tree: Column, key: str) -> Column:
    """How often a tree draws a row: a Poisson(1) count from a hash of (seed, tree, key), the same in any engine and on any retry."""
    u = unit(draw(seed, F.lit("bag"), tree, key))
    return sum(((u >= s).cast("double") for s in POISSON), F.lit(0.0))


def bag_counts(names: list, seed: int, trees: int):
    """`bag_count` of all trees, (rows, trees) in bytes, inside a task: one hash a row and tree, of many rows at a time."""
    import numpy as np

    out = np.empty((trees, len(names)), np.int8)
    for start in range(0, len(names), PIECE):
        rows = [n.encode() for n in names[start : start + PIECE]]
        for t, (high, low) in enumerate(md5.heads([f"{seed}|bag|{t}|" for t in range(trees)], rows)):
            times = out[t, start : start + len(rows)]
            value = high.astype(np.uint64) << np.uint64(16) | low
            times[:] = 0
            for limit in POISSON_48:
                times += value >= np.uint64(limit)
    return np.ascontiguousarray(out.T)


def left_out(seed: int, tree: Column, key: str) -> Column:
    """Whether `bag_count` is 0, at one hash; the sum of comparisons takes one each where it is a condition."""
    return unit(draw(seed, F.lit("bag"), tree, key)) < POISSON[0]


@dataclass(frozen=True)
class BaggedForest:
    """A forest whose trees are known with the rows they drew: `nodes`, and the settings that `bag_count` needs."""

    nodes: DataFrame
    trees: int
    max_depth: int
    seed: int
    max_features: str
    balanced: bool

    def score(self, rows: DataFrame, keep: list, features: str = "features") -> DataFrame:
        return score_nodes(self.nodes, rows, keep, features)

    def out_of_bag(self, train: DataFrame, key: str) -> DataFrame:
        """(key, label, trees, probability): each training row judged by the trees that did not draw it; rows that all drew are left out."""
        rows = train.select(F.col(key).alias("__key"), "label", vector_to_array("features").alias("features"))
        walk, (values, stacked), seed, trees = _walks(self.nodes), _readings(rows, self.nodes, "features"), self.seed, self.trees

        def judged(batches):
            import numpy as np
            import pyarrow as pa

            for b in forest.gathered(batches, PIECE):
                bags = bag_counts(b.column("__name").to_pylist(), seed, trees)
                out = [np.flatnonzero(own) for own in np.ascontiguousarray(bags.T) == 0]
                total, n = np.zeros(b.num_rows), (bags == 0).sum(axis=1)
                for own, p in zip(out, walk(stacked(b), out.__getitem__)):
                    total[own] += p
                some = np.flatnonzero(n)
                arrays = [b.column("__key").take(pa.array(some)), b.column("label").take(pa.array(some)), pa.array(n[some]), pa.array(total[some] / n[some])]
                yield pa.RecordBatch.from_arrays(arrays, [key, "label", "trees", "probability"])

        types = T.StructType([T.StructField(key, rows.schema["__key"].dataType), rows.schema["label"], T.StructField("trees", T.LongType()), T.StructField("probability", T.DoubleType())])
        return rows.select("__key", F.col("__key").cast("string").alias("__name"), "label", *values).mapInArrow(judged, types)

    def oob_score(self, train: DataFrame, key: str) -> DataFrame:
        """(trees, rows, oob_accuracy) of this forest; optimistic on rebalanced rows, whose parents may be in the bag."""
        right = (F.col("probability") > 0.5).cast("double") == F.col("label")
        return self.out_of_bag(train, key).agg(F.lit(self.trees).alias("trees"), F.count(F.lit(1)).alias("rows"), F.avg(right.cast("double")).alias("oob_accuracy"))

    def importances(self, names: list) -> DataFrame:
        """From the counts that training left in the nodes."""
        return importances(self.nodes, self.nodes.select("tree", "node", F.col("n0").alias("c0"), F.col("n1").alias("c1")), names)

    def settings(self) -> dict:
        return {f: getattr(self, f) for f in ("trees", "max_depth", "seed", "max_features", "balanced")}


def fit_bagged_forest(
    train: DataFrame, key: str, trees: int = D.FOREST_TREES, max_depth: int = D.FOREST_DEPTH, balanced: bool = True, seed: int = D.SEED,
    max_bins: int = MAX_BINS, max_features: str = "sqrt",
) -> BaggedForest:
    """A forest of `trees` trees, each grown on its own bag (`bag_count`). train: (key, features vector, label), key unique.

    All trees grow at once, level by level (`forest.grow`). Draws are hashed once a row and tree, written as a byte each.
    """
    spark = train.sparkSession
    dims = len(train.select("features").first()[0])
    data = forest.binned(train, dims, max_bins, balanced, seed, F.col(key).cast("string"), lambda names: bag_counts(names, seed, trees))
    rows = spark.createDataFrame(forest.grow(data, trees, max_depth, max_features, seed), forest.DATA)
    return BaggedForest(_table(rows.select(F.col("treeID").alias("tree"), "nodeData.*"), dims), trees, max_depth, seed, max_features, balanced)


def save_forest(forest: BaggedForest, path: str) -> None:
    forest.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    forest.nodes.sparkSession.createDataFrame([forest.settings()], "trees int, max_depth int, seed long, max_features string, balanced boolean").coalesce(1).write.mode("overwrite").json(f"{path}/settings")


def load_forest(spark: SparkSession, path: str) -> BaggedForest:
    settings = spark.read.schema("trees int, max_depth int, seed long, max_features string, balanced boolean").json(f"{path}/settings").first().asDict()
    return BaggedForest(nodes=spark.read.schema(_NODES).parquet(f"{path}/nodes"), **settings)
