import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from upkeep import defaults as D
from upkeep.operators import choose, evaluate, publish

RNG = np.random.default_rng(11)
PUBLISHED = [  # model, tp, fn, fp, tn, accuracy, precision, recall, f1, auc
    (D.TREE, 61, 7, 132, 1800, 0.9305, 0.3161, 0.8971, 0.4674, 0.9278),
    (D.FOREST, 60, 8, 109, 1823, 0.9415, 0.3550, 0.8824, 0.5063, 0.9710),
    (D.LOGISTIC, 57, 11, 343, 1589, 0.8230, 0.1425, 0.8382, 0.2436, 0.9074),
]


def golden(spark):
    rows = [(i, m, tp, fn, fp, tn, auc) for i, (m, tp, fn, fp, tn, *_, auc) in enumerate(PUBLISHED)]
    cells = spark.createDataFrame(rows, "ordinal int, model string, tp long, fn long, fp long, tn long, auc_roc double")
    return evaluate.binary_metrics(cells)


def test_published_metrics_follow_from_counts(spark):
    got = {r["model"]: r for r in golden(spark).collect()}
    for m, _tp, _fn, _fp, _tn, *want, _auc in PUBLISHED:
        assert [round(got[m][c], 4) for c in ("accuracy", "precision", "recall", "f1")] == want


def test_published_winner(spark):
    assert choose.select_best(golden(spark)).first()["model"] == D.FOREST
    assert choose.best_by_f1(golden(spark)).first()["model"] == D.FOREST
    assert choose.best_by_auc(golden(spark)).first()["model"] == D.FOREST


def metrics(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "ordinal int, model string, recall double, f1 double, auc_roc double")
    return df.withColumns({c: F.lit(0.5) for c in ("accuracy", "precision")}).withColumns(
        {c: F.lit(None).cast("double") for c in ("cv_f1_mean", "cv_f1_std")})


def test_gate_uses_rounded_recall_and_verdict_the_raw_one(spark):
    m = metrics(spark, [("edge", 0.79996, 0.9, 0.9), ("low", 0.79994, 0.99, 0.9), ("sure", 0.9, 0.2, 0.9)])
    assert choose.select_best(m).first()["model"] == "edge"
    checked = {r["model"]: r["verified"] for r in evaluate.hypothesis_check(m).collect()}
    assert checked == {"edge": False, "low": False, "sure": True}
    assert evaluate.all_models_pass(evaluate.hypothesis_check(m)).first()[0] is False


def test_no_model_passes_and_ties(spark):
    assert choose.select_best(metrics(spark, [("a", 0.1, 0.3, 0.5), ("b", 0.2, 0.4, 0.5)])).first()["model"] == "b"
    assert choose.select_best(metrics(spark, [("a", 0.9, 0.30001, 0.5), ("b", 0.9, 0.30002, 0.5)])).first()["model"] == "a"
    assert choose.best_by_f1(metrics(spark, [("a", 0.9, 0.3, 0.5), ("b", 0.9, 0.3, 0.6)])).first()["model"] == "a"
    assert choose.select_best(metrics(spark, [("a", 0.9, 0.3, 0.5), ("b", 0.9, 0.3, 0.6)])).first()["model"] == "b"


def test_ranked_comparison(spark):
    rows = choose.ranked_comparison(metrics(spark, [("a", 0.9, 0.3, 0.5), ("b", 0.1, 0.9, 0.6)])).collect()
    assert [(r["model"], r["is_best"], r["verdict"], r["cv_f1"]) for r in rows] == [
        ("a", True, "NO FALSADA", "N/A"), ("b", False, "FALSADA", "N/A")]


def scored(spark, p, y, model="m"):
    pdf = pd.DataFrame({"key": range(len(p)), "label": y, "probability": p, "prediction": (np.asarray(p) >= 0.5).astype(int), "model": model})
    return spark.createDataFrame(pdf)


def roc_by_hand(p, y):
    """Direct definition: count at every distinct threshold, drop midpoints of straight runs."""
    pts = [(int(((p >= t) & (y == 0)).sum()), int(((p >= t) & (y == 1)).sum())) for t in sorted(set(p), reverse=True)]
    keep = [
        i for i in range(len(pts))
        if i in (0, len(pts) - 1) or any(pts[i + 1][c] - 2 * pts[i][c] + pts[i - 1][c] for c in (0, 1))
    ]
    n, m = (y == 0).sum(), (y == 1).sum()
    return [(0.0, 0.0)] + [(pts[i][0] / n, pts[i][1] / m) for i in keep]


@pytest.mark.parametrize("p", [RNG.random(3_000), np.round(RNG.random(800), 2), RNG.choice([0.2, 0.9], 200)])
def test_roc_against_definition(spark, p):
    y = (RNG.random(len(p)) < 0.2 + 0.5 * p).astype(int)
    df = scored(spark, p, y).repartition(5)
    got = sorted((r["fpr"], r["tpr"]) for r in evaluate.roc_curve(df).collect())
    np.testing.assert_allclose(got, sorted(roc_by_hand(p, y)), atol=1e-12)
    assert got[0] == (0.0, 0.0) and got[-1] == (1.0, 1.0)
    xs, ys = zip(*got)
    auc = evaluate.roc_auc(df).first()["auc_roc"]
    assert auc == pytest.approx(np.trapezoid(ys, xs), abs=1e-12)
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg[None, :]).mean() + (pos[:, None] == neg[None, :]).mean() / 2
    assert auc == pytest.approx(wins, abs=1e-12)


def test_one_class_only(spark):
    df = scored(spark, [0.9, 0.1, 0.2], [0, 0, 0])
    c = evaluate.binary_metrics(evaluate.confusion(df)).first()
    assert (c["tn"], c["fp"], c["fn"], c["tp"]) == (2, 1, 0, 0) and c["recall"] == 0.0 and c["f1"] == 0.0
    assert evaluate.roc_auc(df).first()["auc_roc"] is None


def test_merge_previous_and_none(spark):
    cur = spark.createDataFrame([("a", 0.1, None), ("b", 0.2, 0.5)], "model string, f1 double, cv_f1_mean double")
    prev = spark.createDataFrame([("a", {"x": 0.7}, 0.9)], "model string, feature_importance map<string,double>, cv_f1_mean double")
    got = {r["model"]: r for r in evaluate.merge_previous_metrics(cur, prev).collect()}
    assert got["a"]["cv_f1_mean"] == 0.9 and got["a"]["feature_importance"] == {"x": 0.7}
    assert got["b"]["cv_f1_mean"] == 0.5 and got["b"]["feature_importance"] is None
    with pytest.raises(ValueError):
        evaluate.require_models(cur.limit(0))


def test_documents(spark):
    p = RNG.random(400)
    y = (RNG.random(400) < p).astype(int)
    both = scored(spark, p, y, "b").unionByName(scored(spark, 1 - p, y, "a"))
    rec = evaluate.evaluate_models(both).withColumn("ordinal", F.when(F.col("model") == "b", 0).otherwise(1))
    rec = rec.withColumn("feature_importance", F.create_map(F.lit("x"), F.lit(0.2), F.lit("z"), F.lit(0.8)))
    doc = publish.dashboard_payload(rec).first()
    assert doc["comparacion"]["nombres"] == ["b", "a"] and doc["mejor_modelo"] == "b"
    assert [e["variable"] for e in doc["feature_importance"]] == ["z", "x"]
    fpr, tpr = doc["roc_curves"]["b"]["fpr"], doc["roc_curves"]["b"]["tpr"]
    assert (fpr[0], tpr[0], fpr[-1], tpr[-1]) == (0.0, 0.0, 1.0, 1.0) and fpr == sorted(fpr) and tpr == sorted(tpr)
    assert doc["hipotesis"]["intervalos"]["torque_Nm"] == "> 45.95"
    assert doc["modelos"]["a"]["hipotesis"]["verificada"] is False
    assert publish.notebook_payload(rec).first()["hipotesis_verificada"] is False
    assert len(publish.metrics_table(rec.drop("feature_importance")).columns) == 21
    long = publish.metrics_long(rec).where("section = 'importance' AND model = 'a'").collect()
    assert {(r["name"], r["value"]) for r in long} == {("x", "0.2000"), ("z", "0.8000")}


def test_roc_points(spark):
    p, y = RNG.random(3_000), np.arange(3_000) % 2
    df = scored(spark, p, y)
    curve = evaluate.roc_curve(df)
    every = evaluate.roc_arrays(curve, "all").first()
    once = evaluate.roc_arrays(curve).first()
    assert len(every["fpr"]) == curve.count() and len(once["fpr"]) == len(set(zip(every["fpr"], every["tpr"])))
    assert every["fpr"] == sorted(every["fpr"]) and every["tpr"] == sorted(every["tpr"])
    with pytest.raises(ValueError):
        evaluate.roc_arrays(curve, "some")
    assert evaluate.evaluate_models(df, roc=None).first()["curva_roc"]["fpr"] is None
