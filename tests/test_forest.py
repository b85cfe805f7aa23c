"""Forests grown level by level: draws, cut points, and the same trees on any number of tasks."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from upkeep.operators import columns, forest, train, trees


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 3)).round(3)
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] < -0.4) | (rng.random(4000) < 0.03)).astype(int)
    return columns.select_features(spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(k=[f"r{i}" for i in range(4000)], y=y)), "k", list("abc"), "y")


def nodes_of(model):
    return trees.tree_nodes(model).orderBy("tree", "node").collect()


def test_a_forest_does_not_depend_on_where_rows_lie(table):
    one = train.fit_random_forest(table.coalesce(1), trees=5, max_depth=4)
    many = train.fit_random_forest(table.repartition(7), trees=5, max_depth=4)
    assert nodes_of(one) == nodes_of(many)  # Spark ML draws by partition
    assert one.getNumTrees == 5 and one.getMaxDepth() == 4 and one.getFeatureSubsetStrategy() == "sqrt" and one.numFeatures == 3
    assert train.score(one, table, ["label"]).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0] > 0.9


def test_several_scans_a_level_grow_the_same_trees(table, monkeypatch):
    whole = trees.fit_bagged_forest(table, "k", trees=4, max_depth=4).nodes.orderBy("tree", "node").collect()
    monkeypatch.setattr(forest, "CELLS", 3 * 2 * 256 * 2)
    assert trees.fit_bagged_forest(table, "k", trees=4, max_depth=4).nodes.orderBy("tree", "node").collect() == whole


def test_bags_in_tasks_are_those_of_the_column(table):
    want = table.select("k", *[trees.bag_count(42, F.lit(t), "k").alias(f"b{t}") for t in range(3)]).toPandas()
    assert (trees.bag_counts(want.k.tolist(), 42, 3) == want[["b0", "b1", "b2"]].to_numpy()).all()


def test_drawn_counts_are_poisson():
    row = np.random.default_rng(0).integers(-2**62, 2**62, 200_000)
    draws = forest._drawn(row, 42)
    counts = np.stack([draws(t) for t in range(8)])
    assert abs(counts.mean() - 1) < 0.005 and abs(counts.var() - 1) < 0.01 and np.abs(np.corrcoef(counts) - np.eye(8)).max() < 0.01


def test_cut_points_of_many_and_of_few_values():
    few = pd.DataFrame({"feature": 0, "x": [1.0, 2.0, 4.0, 4.0], "w": 1.0})
    assert forest._cut_points(256)(few)["cuts"][0] == [1.5, 3.0]
    many = pd.DataFrame({"feature": 0, "x": np.arange(1000.0), "w": 1.0})
    np.testing.assert_allclose(forest._cut_points(5)(many)["cuts"][0], [199.5, 399.5, 599.5, 799.5])


@pytest.mark.parametrize("marked", [1, 4, 1000])
def test_rows_are_parted_as_if_walked_one_by_one(marked, monkeypatch):
    monkeypatch.setattr(forest, "MARKED", marked)
    rng = np.random.default_rng(2)
    columns = rng.integers(0, 16, (3, 5000)).astype(np.uint8)
    drawn = rng.random(5000) < 0.6
    feature, cut, left, ends = [], [], [], [0]
    for node in range(25):  # a tree whose nodes are split now and then
        feature.append(int(rng.integers(3)))
        split = node < 3 or rng.random() < 0.6
        cut.append(int(rng.integers(3, 12)) if split else 255)
        left.append(len(ends) if split else node)
        ends += [0, 0] if split else []
    for node in range(25, len(ends)):
        feature, cut, left = [*feature, 0], [*cut, 255], [*left, node]
    ways = np.array(feature), np.array(cut, np.uint8), np.array(left)
    leaves = [n for n in range(len(left)) if left[n] == n]
    slots = np.full(len(left), -1)
    slots[leaves[::2]] = np.arange(len(leaves[::2]))  # the others are not open
    found = {int(s): sorted(held.tolist()) for s, held in forest._held(drawn, ways, slots, forest._leading(slots, ways), columns)}
    want = {}
    for row in np.flatnonzero(drawn):
        node = 0
        while left[node] != node:
            node = left[node] + int(columns[feature[node], row] > cut[node])
        if slots[node] >= 0:
            want.setdefault(int(slots[node]), []).append(int(row))
    assert found == want


def test_batches_are_put_together():
    sizes = [0, 3, 4, 0, 9, 1, 0]
    given = [pa.RecordBatch.from_pydict({"x": pa.array(range(n), pa.int64())}) for n in sizes]
    assert [b.num_rows for b in forest.gathered(given, 6)] == [7, 9, 1]
    assert [v for b in forest.gathered(given, 6) for v in b.column("x").to_pylist()] == [v for n in sizes for v in range(n)]
