"""Sums of products of column pairs, and what is made of them."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from upkeep.operators import correlation
from upkeep.operators.gram import gram


def test_two_hundred_columns_with_nulls_in_one_scan(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 200)) * np.logspace(-3, 5, 200) + 1e6
    x[:, 1::2] += x[:, ::2] * rng.normal(size=100)
    x[:, 7] = 0.1
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 9] = np.nan
    names = [f"c{i}" for i in range(200)]
    pdf = pd.DataFrame(x, columns=names)
    df = spark.createDataFrame(pdf).repartition(9)
    got = correlation.corr_matrix(df, names)
    assert str(got._jdf.queryExecution().optimizedPlan()).count("LogicalRDD") <= 1
    got = got.toPandas().pivot(index="x", columns="y", values="r").loc[names, names].to_numpy(float)
    want = pdf.corr(min_periods=1).to_numpy()
    constant = [7, 9]
    assert np.isnan(got[constant]).all() and np.isnan(got[:, constant]).all()
    rest = [i for i in range(200) if i not in constant]
    np.testing.assert_allclose(got[np.ix_(rest, rest)], want[np.ix_(rest, rest)], atol=1e-6)


def test_weights_and_few_rows(spark):
    rng = np.random.default_rng(5)
    x, w = rng.normal(size=(400, 3)), rng.integers(0, 4, 400).astype(float)
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(w=w)).repartition(6)
    got = gram(df, list("abc"), "w").toPandas().set_index(["i", "j"])
    mean = np.average(x, axis=0, weights=w)
    np.testing.assert_allclose(got.n, w.sum())
    np.testing.assert_allclose(got.both.to_numpy().reshape(3, 3), (x - mean).T @ ((x - mean) * w[:, None]), atol=1e-9)
    np.testing.assert_allclose(got.mean_i.to_numpy().reshape(3, 3)[:, 0], mean, atol=1e-12)
    assert gram(df.limit(0), list("abc")).count() == 0
    one = gram(df.limit(1), ["a", "b"]).collect()
    assert all(r["n"] == 1 and r["both"] == 0 for r in one)
    assert correlation.corr_matrix(df.limit(1), ["a", "b"]).where(F.col("r").isNotNull()).count() == 0
