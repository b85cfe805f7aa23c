import numpy as np
import pandas as pd
import pytest

from upkeep.operators.quantiles import long_values, merged, quantiles, sketched_quantiles, sketches
from upkeep.operators.running import prefix_scan

RNG = np.random.default_rng(7)
SHAPES = {
    "lognormal": RNG.lognormal(0, 4, 20_000),
    "negative": -RNG.normal(1e6, 1, 20_000),
    "constant": np.full(500, 3.25),
    "one_third_copies": np.concatenate([np.full(7_000, 0.5), RNG.normal(size=13_000)]),
    "lattice": RNG.integers(0, 11, 20_000) / 100,
    "two_rows": np.array([1.0, 2.0]),
    "one_row": np.array([4.0]),
    "outlier": np.concatenate([RNG.normal(size=999), [1e300]]),
}
PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_exact_against_numpy(spark, accuracy):
    pdf = pd.concat([pd.DataFrame({"g": k, "value": v}) for k, v in SHAPES.items()])
    df = spark.createDataFrame(pdf).repartition(7)
    names = [f"q{i}" for i in range(len(PROBS))]
    got = quantiles(df, ["g"], PROBS, names, accuracy=accuracy).toPandas().set_index("g")
    assert len(got) == len(SHAPES)
    for k, v in SHAPES.items():
        np.testing.assert_allclose(got.loc[k, names].astype(float), np.quantile(v, PROBS), rtol=1e-12, err_msg=k)


def test_approx_and_unknown_method(spark):
    df = spark.createDataFrame(pd.DataFrame({"g": "a", "value": np.arange(101.0)}))
    assert quantiles(df, ["g"], [0.5], ["m"], method="approx").first()["m"] == 50.0
    with pytest.raises(ValueError):
        quantiles(df, ["g"], [0.5], ["m"], method="guess")


def test_nulls_and_all_null_column(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, None), (3, 3.0, None)], "k int, a double, b double")
    got = quantiles(long_values(df, [], ["a", "b"]), ["variable"], [0.5], ["m"]).toPandas()
    assert got.values.tolist() == [["a", 2.0]]


@pytest.mark.parametrize("n", [1, 5_000, 60_000])
def test_prefix_scan(spark, n):
    pdf = pd.DataFrame({"g": np.where(np.arange(n) % 3 == 0, "a", "b"), "v": RNG.permutation(n) / 7.0, "w": RNG.integers(0, 9, n), "u": 1})
    got = prefix_scan(spark.createDataFrame(pdf).repartition(5), "g", "v", ["w", "u"]).toPandas().sort_values(["g", "v"]).reset_index(drop=True)
    want = pdf.sort_values(["g", "v"]).reset_index(drop=True)
    by = want.groupby("g")
    for c in ("w", "u"):
        assert (got[f"{c}_below"] == by[c].cumsum() - want[c]).all()
        assert got[f"{c}_before"].fillna(-1).tolist() == by[c].shift(1).fillna(-1).tolist()


def test_prefix_scan_of_nulls_and_nothing(spark):
    rows = [(None, None, 2), (None, 1.0, 3), ("a", None, 4), ("a", 2.0, 5)]
    got = prefix_scan(spark.createDataFrame(rows, "g string, v double, w bigint"), "g", "v", ["w"]).collect()
    assert sorted((str(r["g"]), r["w"], r["w_below"], r["w_before"]) for r in got) == [("None", 2, 0, None), ("None", 3, 2, 2), ("a", 4, 0, None), ("a", 5, 4, 4)]
    assert prefix_scan(spark.createDataFrame([], "g string, v double, w bigint"), "g", "v", ["w"]).count() == 0


def test_stored_sketches_of_batches(spark, tmp_path):
    values = RNG.lognormal(0, 2, 200_000)
    paths = [str(tmp_path / f"day{i}") for i in range(4)]
    for p, v in zip(paths, np.split(values, 4)):
        sketches(spark.createDataFrame(pd.DataFrame({"g": "a", "value": v})), ["g"]).write.parquet(p)
    whole = merged([spark.read.parquet(p) for p in paths], ["g"])
    row = sketched_quantiles(whole, ["g"], [0.25, 0.5, 0.99], ["q1", "m", "top"]).first()
    assert row["n"] == 200_000
    for p, q in zip((0.25, 0.5, 0.99), (row["q1"], row["m"], row["top"])):
        assert abs((values < q).mean() - p) < 0.002


def test_many_groups(spark):
    from pyspark.sql import functions as F

    from upkeep.operators.quantiles import quantiles

    df = spark.range(60_000).select((F.col("id") % 20_000).alias("g"), F.floor(F.col("id") / 20_000).cast("double").alias("value"))
    got = quantiles(df, ["g"], [0.5], ["median"])
    assert got.count() == 20_000 and got.where("median <> 1").count() == 0
