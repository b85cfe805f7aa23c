import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from upkeep.operators import prep
from upkeep.operators.bounds import bounded, settle, spread
from upkeep.operators.neighbours import listed_rows, nearest_neighbours, unlisted_rows
from upkeep.operators.smote import smote

RNG = np.random.default_rng(3)


def table(spark, sizes, parts=4):
    rows = [(f"{c}-{i}", c) for c, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "k string, y int").repartition(parts)


@pytest.mark.parametrize("sizes", [{0: 967, 1: 33}, {0: 3, 1: 1}, {0: 10, 1: 10, 2: 11}, {0: 50}])
def test_split_counts(spark, sizes):
    got = prep.stratified_split(table(spark, sizes), "k", "y").toPandas()
    n = sum(sizes.values())
    assert len(got) == n and got["k"].is_unique
    assert (got["split"] == "test").sum() == math.ceil(n * 0.2)
    for c, m in sizes.items():
        in_test = ((got["split"] == "test") & (got["y"] == c)).sum()
        assert abs(in_test - m * math.ceil(n * 0.2) / n) < 1


def test_split_and_folds_do_not_depend_on_partitioning(spark):
    seen = set()
    for parts in (1, 7, 64):
        df = table(spark, {0: 300, 1: 41}, parts)
        s = prep.stratified_split(df, "k", "y").select("k", "split")
        f = prep.stratified_folds(df, "k", "y").select("k", "fold")
        rows = s.join(f, "k").orderBy("k").collect()
        seen.add(tuple(map(tuple, rows)))
    assert len(seen) == 1


def test_seed_changes_the_split(spark):
    df = table(spark, {0: 300, 1: 41})
    a, b = (prep.stratified_split(df, "k", "y", seed=s).where("split = 'test'").select("k") for s in (1, 2))
    assert a.exceptAll(b).count() > 0


@pytest.mark.parametrize("sizes", [{0: 103, 1: 12}, {0: 7, 1: 3}])
def test_fold_sizes(spark, sizes):
    got = prep.stratified_folds(table(spark, sizes), "k", "y").toPandas()
    assert got["fold"].between(0, 4).all()
    for c, n in sizes.items():
        per = got[got["y"] == c]["fold"].value_counts().reindex(range(5), fill_value=0)
        assert per.sum() == n and per.max() - per.min() <= 1


def test_split_plan_moves_no_wide_rows(spark):
    df = table(spark, {0: 50, 1: 5}).withColumn("wide", F.lit("x"))
    plan = prep.stratified_split(df, "k", "y")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("wide" in line for line in exchanges)


def test_scaler(spark):
    train = spark.createDataFrame([(1.0, 5.0, 2), (2.0, 5.0, 4), (4.0, 5.0, None)], "a double, b double, c int")
    scaler = prep.fit_scaler(train, ["a", "b", "c"])
    rows = {r["variable"]: (r["mean"], r["scale"]) for r in scaler.collect()}
    assert rows["a"][1] == pytest.approx(np.std([1, 2, 4])) and rows["b"] == (5.0, 1.0) and rows["c"] == (3.0, 1.0)
    z = prep.apply_scaler(train, scaler, ["a", "b", "c"]).toPandas()
    assert z["a"].mean() == pytest.approx(0, abs=1e-12) and z["a"].std(ddof=0) == pytest.approx(1)
    assert (z["b"] == 0).all()


def test_class_weights(spark):
    got = {r["y"]: r["weight"] for r in prep.class_weights(table(spark, {0: 90, 1: 10}), "y").collect()}
    assert got == {0: pytest.approx(100 / 180), 1: pytest.approx(5.0)}


def test_bounded_fails_loudly_and_keeps_all_rows(spark):
    assert bounded(spark.range(5), "t", 5).count() == 5
    with pytest.raises(Exception, match="more than 4 rows"):
        bounded(spark.range(5), "t", 4).count()


def brute(keys, x, k):
    out = {}
    for i in range(len(keys)):
        d = np.zeros(len(keys))
        for j in range(x.shape[1]):
            d += (x[i, j] - x[:, j]) ** 2
        order = sorted((d[m], keys[m]) for m in range(len(keys)) if m != i)
        out[keys[i]] = [key for _, key in order[:k]]
    return out


@pytest.mark.parametrize("cell", [10_000, 40])
def test_neighbours_against_brute_force(spark, cell):
    x = np.concatenate([
        RNG.normal(size=(250, 3)), np.round(RNG.normal(size=(150, 3))),  # lattice: many ties
        np.tile([[0.5, 0.5, 0.5]], (4, 1)), RNG.normal(size=(3, 3)) * 1e4,
    ])
    keys = [f"r{i:04d}" for i in RNG.permutation(len(x))]
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(k=keys)
    want = brute(keys, x, 5)
    for parts in (1, 9):
        df = spark.createDataFrame(pdf).repartition(parts)
        places = nearest_neighbours(df, "k", ["a", "b", "c"], 5, cell_points=cell)
        got = {r["key"]: [n["key"] for n in r["near"]] for r in listed_rows(places, 5).collect()}
        hot = [k for k in keys if k not in got]  # further copies of a crowded lattice point
        for key in got:
            assert got[key] == want[key]
        at = dict(zip(keys, map(tuple, x)))
        for key in hot:
            assert all(at[n] == at[key] for n in want[key])


def test_smote_properties(spark):
    n0, n1 = 120, 40
    pdf = pd.DataFrame({
        "k": [f"k{i}" for i in range(n0 + n1)], "y": [0] * n0 + [1] * n1,
        "a": RNG.normal(size=n0 + n1), "b": RNG.normal(size=n0 + n1), "code": RNG.integers(0, 3, n0 + n1).astype(float),
    })
    pdf.loc[n0 : n0 + 14, ["a", "b", "code"]] = [0.25, 0.25, 1.0]  # a third of the class are copies
    feats = ["a", "b", "code"]
    results = []
    for parts, cell in ((1, 2_000), (7, 10)):
        out = smote(spark.createDataFrame(pdf).repartition(parts), "k", feats, "y", categorical=["code"], cell_points=cell).toPandas()
        results.append(out.sort_values("k").reset_index(drop=True))
    pd.testing.assert_frame_equal(*results)
    out = results[0]
    assert out["y"].value_counts().to_dict() == {0: n0, 1: n0} and out["k"].is_unique
    kept = out[~out["synthetic"]].merge(pdf, on="k", suffixes=("", "_was"))
    assert len(kept) == n0 + n1 and (kept["a"] == kept["a_was"]).all()
    minority = pdf[pdf["y"] == 1].reset_index(drop=True)
    near = brute(minority["k"].tolist(), minority[feats].to_numpy(), 5)
    at = minority.set_index("k")[feats]
    for r in out[out["synthetic"]].itertuples():
        base = at.loc[r.base_key]
        assert r.code == base["code"]
        p, ok = np.array([r.a, r.b]), False
        for other in near[r.base_key]:
            d = (at.loc[other] - base)[["a", "b"]].to_numpy()
            s = p - base[["a", "b"]].to_numpy()
            length = d @ d
            u = 0.0 if length == 0 else (s @ d) / length
            ok |= -1e-9 <= u < 1 + 1e-9 and np.allclose(s, u * d, atol=1e-12)
        assert ok


def test_smote_needs_more_rows_than_neighbours(spark):
    df = table(spark, {0: 20, 1: 5}).withColumn("a", F.rand(1))
    with pytest.raises(ValueError, match="more than k=5"):
        smote(df, "k", ["a"], "y")


def test_null_labels_are_split_as_a_class(spark):
    from pyspark.sql import functions as F

    from upkeep.operators import prep

    df = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") >= 100, F.col("id") % 2).alias("y"))
    got = prep.stratified_split(df, "k", "y")
    assert got.where("split = 'test'").count() == 200 and got.where("split = 'test' and y is null").count() == 20


def test_spread_makes_more_tasks_of_more_rows(spark):
    """A task's share is bounded by size; a count of tasks fixed by the cores would let it grow with the input."""
    def tasks(n):
        rows = spread(spark.range(0, n, 1, n // 10_000).select("id", F.md5(F.col("id").cast("string")).alias("x")))
        return len(settle(rows).inputFiles())

    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        few, many = tasks(50_000), tasks(800_000)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert many > 2 * few and many > spark.sparkContext.defaultParallelism


def test_spread_by_a_column_and_the_readings_sort_no_rows(spark, monkeypatch):
    """Rows dealt out in turn are sorted first, whole, and spill once a task's share outgrows its memory."""
    from checks import fixture

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    monkeypatch.setattr(fixture, "settle", lambda df: df)
    monkeypatch.setattr(fixture, "_made", {})
    made = plan(fixture.readings(spark, "/root/testdata/sf0.001"))
    assert "RoundRobin" not in made and "REBALANCE" in made
    made = plan(spread(spark.range(0, 1000, 1, 4), "id"))
    assert "RoundRobin" not in made and "REBALANCE" in made


@pytest.mark.parametrize("cell", [10_000, 8])
def test_every_copy_of_a_crowded_point_has_its_neighbours(spark, cell):
    x = np.concatenate([np.tile([[0.5, -0.0]], (20, 1)), RNG.normal(size=(30, 2)), np.tile([[2.0, 1.0]], (6, 1)), np.tile([[0.0, 7.0]], (7, 1))])
    keys = [f"r{i:04d}" for i in RNG.permutation(len(x))]
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"]).assign(k=keys)).repartition(5)
    places = settle(nearest_neighbours(df, "k", ["a", "b"], 5, cell_points=cell))
    rows = listed_rows(places, 5).unionByName(unlisted_rows(df, places, "k", ["a", "b"], 5)).collect()
    got = {r["key"]: [n["key"] for n in r["near"]] for r in rows}
    assert len(rows) == len(x) and got == brute(keys, x, 5)


def test_smote_reads_its_input_three_times_at_most(spark):
    """Sizes, rows of the small class, rows kept: the steps for the small class do not read the other one again and again."""
    n0, n1 = 400, 40
    read = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            read.add(len(b))
            yield b

    pdf = pd.DataFrame({"k": [f"k{i}" for i in range(n0 + n1)], "y": [0] * n0 + [1] * n1, "a": RNG.normal(size=n0 + n1)})
    df = spark.createDataFrame(pdf)
    out = smote(df.mapInPandas(passed, df.schema), "k", ["a"], "y", cell_points=10)
    assert out.count() == 2 * n0 and 0 < read.value <= 3 * (n0 + n1)


def test_rounded_equals_round_at_ties_and_ends(spark):
    from upkeep.functions import scalars as S

    ties = (np.arange(-2000, 2000) + 0.5) / 1e9
    x = np.concatenate([RNG.normal(size=20_000), RNG.normal(size=2_000) * 1e-9, ties, np.nextafter(ties, 1), np.nextafter(ties, -1), ties + 3,
                        [0.0, -0.0, 1e-300, -1e-10, 99.9999999995, 100.0000000005, 1e15 + 0.3, -1e300, np.inf, -np.inf, np.nan]])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
    for digits in (9, 2):
        got = df.select(S.rounded(F.col("x"), digits).alias("a"), F.round("x", digits).alias("b")).toPandas()
        assert got["a"].to_numpy().tobytes() == got["b"].to_numpy().tobytes()


def test_scaled_values_are_rounded_without_decimals_first(spark):
    """`round` makes a decimal number of every value, most of the time that writing scaled rows took."""
    df = spark.createDataFrame([(1.0,), (2.5,)], "a double")
    plan = prep.apply_scaler(df, prep.fit_scaler(df, ["a"]), ["a"], digits=9)._jdf.queryExecution().executedPlan().toString()
    assert "CASE WHEN" in plan and "ELSE round(" in plan
