"""Trees as tables: against the fitted models, against DuckDB on leaf boxes, and a forest that knows its bags."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from upkeep.operators import columns, train, trees

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 3)).round(2)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] < -0.2) | (rng.random(3000) < 0.05)).astype(int)
    df = spark.createDataFrame(pd.DataFrame(x, columns=NAMES).assign(k=[f"r{i}" for i in range(3000)], y=y))
    return columns.select_features(df, "k", NAMES, "y").persist()


@pytest.fixture(scope="module")
def arrays(rows):
    return rows.select("k", "label", vector_to_array("features").alias("features")).persist()


@pytest.fixture(scope="module")
def bagged(rows):
    return trees.fit_bagged_forest(rows, "k", trees=12, max_depth=4)


def boxes_in_duckdb(nodes, arrays):
    boxes, points = trees.leaf_boxes(nodes).toPandas(), arrays.toPandas()
    con = duckdb.connect()
    con.register("b", pd.DataFrame({"tree": boxes.tree, "p": boxes.p, **{f"l{i}": [v[i] for v in boxes.lower] for i in range(3)}, **{f"u{i}": [v[i] for v in boxes.upper] for i in range(3)}}))
    con.register("r", pd.DataFrame({"k": points.k, **{f"x{i}": [v[i] for v in points.features] for i in range(3)}}))
    inside = " AND ".join(f"x{i} > l{i} AND x{i} <= u{i}" for i in range(3))
    return con.sql(f"SELECT k, count(*) AS hits, count(DISTINCT tree) AS trees, avg(p) AS p FROM r JOIN b ON {inside} GROUP BY k").df().set_index("k")


@pytest.mark.parametrize("kind", ["tree", "forest"])
def test_table_scores_as_the_model_and_as_boxes_do(rows, arrays, kind):
    model = train.fit_decision_tree(rows, max_depth=5) if kind == "tree" else train.fit_random_forest(rows, trees=15, max_depth=5)
    nodes = trees.tree_nodes(model)
    want = train.score(model, rows, ["k"]).toPandas().set_index("k").sort_index()
    got = trees.score_nodes(nodes, arrays, ["k"]).toPandas().set_index("k").sort_index()
    assert (got.prediction == want.prediction).all()
    np.testing.assert_allclose(got.probability, want.probability, atol=1e-12)
    n = 1 if kind == "tree" else 15
    boxed = boxes_in_duckdb(nodes, arrays).sort_index()
    assert (boxed.hits == n).all() and (boxed.trees == n).all()  # one box of each tree
    np.testing.assert_allclose(boxed.p, want.probability, atol=1e-12)


def test_counts_and_importances_of_a_tree_come_from_the_data(spark, rows, arrays):
    model = train.fit_decision_tree(rows, max_depth=5)
    nodes = trees.tree_nodes(model)
    weight = train.weighted(rows, True).select("k", "weight")
    pairs = trees.reached(arrays.join(weight, "k"), nodes, ["k", "label", "weight"])
    counts = trees.node_counts(nodes, pairs)
    both = nodes.join(counts, ["tree", "node"]).toPandas()
    assert len(both) == nodes.count() == model.numNodes
    np.testing.assert_allclose(both[["n0", "n1"]], both[["c0", "c1"]], rtol=1e-9, atol=1e-9)
    got = {r["variable"]: r["importance"] for r in trees.importances(nodes, counts, NAMES).collect()}
    np.testing.assert_allclose([got[n] for n in NAMES], model.featureImportances.toArray(), atol=1e-9)


def test_importances_of_a_forest(rows):
    model = train.fit_random_forest(rows, trees=7, max_depth=4)
    nodes = trees.tree_nodes(model)
    got = {r["variable"]: r["importance"] for r in trees.importances(nodes, nodes.select("tree", "node", F.col("n0").alias("c0"), F.col("n1").alias("c1")), NAMES).collect()}
    np.testing.assert_allclose([got[n] for n in NAMES], model.featureImportances.toArray(), atol=1e-9)


def test_out_of_bag_is_the_vote_of_trees_that_did_not_draw_the_row(spark, rows, arrays, bagged):
    counts = arrays.select("k", "label", *[trees.bag_count(bagged.seed, F.lit(t), "k").alias(f"b{t}") for t in range(12)]).toPandas().set_index("k")
    drawn = counts[[f"b{t}" for t in range(12)]].to_numpy()
    assert abs(drawn.mean() - 1) < 0.05 and abs(drawn.var() - 1) < 0.1  # Poisson(1)
    leaf = trees.reached(arrays, bagged.nodes, ["k"]).toPandas().pivot(index="k", columns="tree", values="p").loc[counts.index].to_numpy()
    left = drawn == 0
    some = left.any(axis=1)
    want = (leaf * left).sum(axis=1)[some] / left.sum(axis=1)[some]
    got = bagged.out_of_bag(rows, "k").toPandas().set_index("k").loc[counts.index[some]]
    np.testing.assert_allclose(got.probability, want, atol=1e-12)
    assert (got.trees == left.sum(axis=1)[some]).all()
    score = bagged.oob_score(rows, "k").first()
    assert score["rows"] == some.sum() and score["trees"] == 12
    assert score["oob_accuracy"] == pytest.approx(((want > 0.5) == (counts.label[some] == 1)).mean())
    # the nodes count what the bags hold
    weight = train.weighted(rows, True).select("k", F.col("weight").alias("w"))
    pairs = trees.reached(arrays.join(weight, "k"), bagged.nodes, ["k", "label", "w"]).withColumn("weight", F.col("w") * trees.bag_count(bagged.seed, F.col("tree"), "k"))
    both = bagged.nodes.join(trees.node_counts(bagged.nodes, pairs), ["tree", "node"]).toPandas()
    np.testing.assert_allclose(both[["n0", "n1"]], both[["c0", "c1"]], rtol=1e-9, atol=1e-9)


def test_saved_forest_scores_and_judges_as_before(spark, rows, arrays, bagged, tmp_path):
    trees.save_forest(bagged, str(tmp_path))
    again = trees.load_forest(spark, str(tmp_path))
    assert again.settings() == bagged.settings() and again.nodes.orderBy("tree", "node").collect() == bagged.nodes.orderBy("tree", "node").collect()
    assert again.oob_score(rows, "k").collect() == bagged.oob_score(rows, "k").collect()
    got = again.score(arrays, ["k", "label"]).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert got > 0.9
    assert again.importances(NAMES).agg(F.sum("importance")).first()[0] == pytest.approx(1)


def test_a_tree_of_one_leaf_and_null_readings(spark, rows):
    one = rows.withColumn("label", F.lit(1.0))
    nodes = trees.tree_nodes(train.fit_decision_tree(one, balanced=False))
    assert nodes.count() == 1 and nodes.first()["feature"] == -1
    odd = spark.createDataFrame([("x", [None, 1.0, 2.0])], "k string, features array<double>")
    assert trees.score_nodes(nodes, odd, ["k"]).collect()[0]["prediction"] == 1
    nodes = trees.tree_nodes(train.fit_decision_tree(rows, max_depth=2))
    assert trees.score_nodes(nodes, odd, ["k"]).count() == 1
    assert trees.importances(trees.tree_nodes(train.fit_decision_tree(one, balanced=False)), nodes.select("tree", "node", F.lit(0.0).alias("c0"), F.lit(0.0).alias("c1")), NAMES).count() == 3
