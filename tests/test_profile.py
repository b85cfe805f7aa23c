import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from upkeep.functions import scalars as S
from upkeep.operators import charts, columns, correlation, infer, profile

RNG = np.random.default_rng(5)


def p_of(spark, t, df):
    return spark.range(1).select(infer.two_sided_p(F.lit(float(t)), F.lit(float(df)))).first()[0]


@pytest.mark.parametrize("t,df,p", [  # standard two-sided critical values
    (2.228, 10, 0.05), (3.169, 10, 0.01), (12.706, 1, 0.05), (1.960, 10_000, 0.05), (2.576, 1_000_000, 0.01), (2.042, 30, 0.05),
])
def test_p_values_against_tables(spark, t, df, p):
    assert p_of(spark, t, df) == pytest.approx(p, rel=2e-3)


def test_p_value_edges(spark):
    assert p_of(spark, 0, 5) == pytest.approx(1.0)
    assert p_of(spark, 1, 1) == pytest.approx(0.5)
    assert p_of(spark, 80, 50) < 1e-40


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(0, 1.0, 5.0, None), (1, 2.0, 5.0, None), (0, 3.0, 5.0, None)], "y int, a double, c double, e double")
    r = {x["variable"]: x["r"] for x in correlation.corr_with_target(df, ["a", "c", "e"], "y").collect()}
    assert r["a"] == pytest.approx(0.0) and r["c"] is None and r["e"] is None
    t = {x["variable"]: x for x in infer.t_test_by_class(df, ["a", "c", "e"], "y").collect()}
    assert t["c"]["t"] is None and t["c"]["p"] is None and t["e"]["n0"] == 0
    d = {x["variable"]: x for x in profile.describe_features(df, ["a", "e"]).collect()}
    assert d["e"]["count"] == 0 and d["e"]["median"] is None and d["a"]["median"] == 2.0


def test_corr_skips_pairs_with_a_null(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, 4, np.nan], "b": [2.0, 1, np.nan, 5, 6]})
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    got = correlation.corr_matrix(df, ["a", "b"]).where("x = 'a' AND y = 'b'").first()["r"]
    assert got == pytest.approx(pdf["a"].corr(pdf["b"]))


def test_no_failures(spark):
    df = spark.createDataFrame([(0,), (0,)], "y int")
    row = profile.class_distribution(df, "y").first()
    assert row["failures"] == 0 and row["imbalance"] is None
    empty = profile.class_distribution(df.limit(0), "y").first()
    assert empty["total"] == 0 and empty["failure_pct"] is None


def test_missing_mode_columns(spark):
    df = spark.createDataFrame([("a", 1, 0)], "k string, TWF int, HDF int")
    assert [r["mode"] for r in profile.mode_frequency(df).collect()] == ["TWF", "HDF"]
    assert [r["mode"] for r in columns.by_mode(df).collect()] == ["TWF"]
    assert columns.by_mode(df, ["OSF"]).count() == 0


def test_require_columns(spark):
    with pytest.raises(ValueError, match="gone"):
        columns.require_columns(spark.range(1), ["id", "gone"])


def test_null_feature_is_refused(spark):
    df = spark.createDataFrame([(1, None, 0)], "k int, a double, y int")
    with pytest.raises(Exception, match="null"):
        columns.select_features(df, "k", ["a"], "y").collect()


def test_nan_feature_is_refused(spark):
    df = spark.createDataFrame([(1, float("nan"), 0)], "k int, a double, y int")
    with pytest.raises(Exception, match="NaN"):
        columns.select_features(df, "k", ["a"], "y").collect()


def test_rows_are_chosen_before_their_vectors_are_made(spark):
    df = spark.range(100).selectExpr("id AS k", "id / 7 AS a", "CAST(id % 2 AS int) AS y")
    plan = columns.select_features(df, "k", ["a"], "y").where("k % 10 = 3")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("UDF") < plan.index("Filter")  # the filter is below
    assert [r["features"][0] for r in columns.select_features(df, "k", ["a"], "y").where("k = 14").collect()] == [2.0]


def test_words(spark):
    row = spark.range(1).select(
        S.significance_stars(F.lit(0.0009)), S.significance_stars(F.lit(0.05)), S.corr_strength(F.lit(-0.71)), S.corr_strength(F.lit(0.3)),
        S.sign_tag(F.lit(0.0)), S.verdict(F.lit(True)),
    ).first()
    assert tuple(row) == ("***", "n.s.", "alta", None, "[-]", "NO FALSADA")


def test_histogram_against_numpy(spark):
    data = {"normal": RNG.normal(size=3_000), "lattice": RNG.integers(0, 11, 2_000) / 100, "constant": np.full(10, 2.0)}
    pdf = pd.concat([pd.DataFrame({"g": k, "value": v}) for k, v in data.items()])
    got = charts.histogram(spark.createDataFrame(pdf), ["g"], 40).toPandas()
    for k, v in data.items():
        density, edges = np.histogram(v, bins=40, density=True)
        mine = got[got["g"] == k].sort_values("bin")
        np.testing.assert_allclose(mine["density"], density, rtol=1e-9)
        np.testing.assert_allclose(mine["lo"], edges[:-1], atol=1e-12)


def test_boxplot(spark):
    v = np.concatenate([np.arange(1.0, 12.0), [100.0, -50.0]])
    df = spark.createDataFrame(pd.DataFrame({"y": 0, "a": v}))
    b = charts.boxplot_stats(df, ["a"], "y").first()
    assert (b["whisker_low"], b["whisker_high"], b["outliers"], b["median"]) == (1.0, 11.0, 2, 6.0)


def test_scatter_sample_is_stable(spark):
    df = spark.range(2_000).withColumn("v", F.col("id") * 1.0)
    a = charts.scatter_sample(df.repartition(3), "id", ["v"], 0.1)
    b = charts.scatter_sample(df.repartition(11), "id", ["v"], 0.1)
    assert a.exceptAll(b).count() == 0 and 120 < a.count() < 280


@pytest.mark.parametrize("n", [1, 10, 1_000_000])
def test_codes_of_any_number_of_categories(spark, n):
    df = spark.range(n).select(F.lpad(F.col("id").cast("string"), 7, "0").alias("c")).union(spark.createDataFrame([(None,), ("0000000",)], "c string"))
    got = columns.encode_category(df.repartition(6), "c", "code")
    assert got.where("code <> CAST(c AS int)").count() == 0 and got.where("code IS NULL").count() == 1 and got.count() == n + 2


def test_rules_without_failures_are_to_be_reviewed(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0)], "f1 double, failure int")
    got = profile.validate_intervals(df, [("f1", ">", 1.0, "Nm")], "failure")
    assert [(r["ok"], r["q1"]) for r in got.collect()] == [(False, None)]
    assert profile.intervals_concordant(got).first()["concordant"] is False
