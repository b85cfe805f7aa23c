import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixture as X
from upkeep.operators import columns, evaluate, prep, train
from upkeep.operators.smote import smote
from upkeep.plans import stages
from upkeep.sources import readings as src
from upkeep.sources import store
from upkeep.streaming import live

DIR = "/root/testdata/sf0.001"
RNG = np.random.default_rng(2)


@pytest.fixture(scope="module")
def data(spark):
    df = columns.encode_category(X.readings(spark, DIR), "kind", "code")
    return stages.prepare(df, "k", [*X.FEATURES, "code"], "failure")


@pytest.fixture(scope="module")
def models(data):
    return stages.train_models(data["balanced"], "k", [*X.FEATURES, "code"], "failure", trees=10)


def newton(x, y, c, steps=50):
    """Minimise sum of log losses + |w|^2 / (2c), intercept free."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(a.shape[1]), np.diag([1.0 / c] * x.shape[1] + [0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-a @ w))
        w -= np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + penalty, a.T @ (p - y) + penalty @ w)
    return w


@pytest.mark.parametrize("c", [1.0, 0.05])
def test_logistic_against_newton(spark, c):
    x = RNG.normal(size=(400, 3))
    y = (RNG.random(400) < 1 / (1 + np.exp(-(x @ [1.5, -2, 0] + 0.3)))).astype(float)
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(k=range(400), y=y))
    model = train.fit_logistic_regression(columns.select_features(df, "k", list("abc"), "y"), c=c)
    want = newton(x, y, c)
    np.testing.assert_allclose([*model.coefficients, model.intercept], want, atol=1e-4)
    steps = train.newton_step(model, columns.select_features(df, "k", list("abc"), "y", as_vector=False), list("abc"), c).collect()
    np.testing.assert_allclose([r["coefficient"] - r["step"] for r in steps], want, atol=1e-7)  # one step reaches the optimum
    rows = train.coefficients(spark, model, list("abc")).orderBy("rank").collect()
    assert [r["variable"] for r in rows] == ["b", "a", "c"] and [r["sign"] for r in rows][:2] == ["[-]", "[+]"]
    assert train.convergence(spark, model).first()["converged"]


def test_trained_models_find_failures(spark, data, models):
    records = {r["model"]: r for r in stages.evaluate(models, data["test"], "k", [*X.FEATURES, "code"], "failure").collect()}
    assert len(records) == 3
    for r in records.values():
        assert r["confusion_matrix"]["tp"] + r["confusion_matrix"]["fn"] == round(213 * 0.2)
    forest = records["Bosque Aleatorio"]
    assert forest["auc_roc"] > 0.9 and forest["recall"] > 0.7
    assert forest["auc_roc"] > records["Regresión Logística"]["auc_roc"]


def test_tree_reports(spark, models):
    tree, forest = models["Árbol de Decisión"], models["Bosque Aleatorio"]
    shape = train.tree_shape(spark, tree).first()
    assert shape["depth"] <= 6 and shape["leaves"] == shape["inner_nodes"] + 1
    imp = train.feature_importance(spark, forest, [*X.FEATURES, "code"]).orderBy("rank").toPandas()
    assert imp["importance"].sum() == pytest.approx(1.0) and imp["importance"].is_monotonic_decreasing
    params = {r["param"]: r["value"] for r in train.model_params(spark, tree).collect()}
    assert params["maxDepth"] == "6" and params["impurity"] == "gini"


def test_save_load_and_stream_agree_with_batch(spark, data, models, tmp_path):
    feats = [*X.FEATURES, "code"]
    model = train.with_scaler(models["Bosque Aleatorio"], data["scaler"], feats)
    raw = data["split"].where("split = 'test'").drop("split")
    batch = train.score(model, raw, ["k"]).orderBy("k").collect()
    direct = train.score(models["Bosque Aleatorio"], columns.select_features(data["test"], "k", feats, "failure"), ["k"])
    assert [r["prediction"] for r in direct.orderBy("k").collect()] == [r["prediction"] for r in batch]

    store.save_model(model, str(tmp_path / "m"))
    loaded = store.load_model(spark, str(tmp_path / "m"))
    assert train.score(loaded, raw, ["k"]).orderBy("k").collect() == batch

    raw.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = live.score_stream(loaded, live.stream_readings(spark, str(tmp_path / "in"), raw.schema, 1), ["k"])
    live.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "mark"))
    assert spark.read.parquet(str(tmp_path / "out")).orderBy("k").collect() == batch
    with pytest.raises(FileNotFoundError):
        store.load_model(spark, str(tmp_path / "none"))


def test_cross_validation_resampled_inside_folds_is_lower(spark, data):
    feats = [*X.FEATURES, "code"]
    fits = {"tree": lambda rows: train.fit_decision_tree(rows, max_depth=4)}
    leaky = stages.cross_validated(data["balanced"], "k", fits, feats, "failure", k=3).first()

    ready = columns.select_features(data["train"], "k", feats, "failure", as_vector=False)
    wide = ready.select("k", *[F.col("features")[i].alias(f) for i, f in enumerate(feats)], F.col("label").cast("int").alias("failure"))
    folds = prep.stratified_folds(wide, "k", "failure", 3)

    def fit(rows):
        model = train.fit_decision_tree(columns.select_features(rows, "k", feats, "failure"), max_depth=4)
        return lambda part: train.score(
            model, columns.select_features(part, "k", feats, "failure").join(part.select("k", "fold"), "k"), ["label", "fold"])

    honest = evaluate.cv_summary(evaluate.cross_validate(
        folds.withColumn("label", F.col("failure")), fit, "tree", k=3,
        resample=lambda part: smote(part.drop("fold", "label"), "k", feats, "failure"))).first()
    assert honest["cv_f1_mean"] < leaky["cv_f1_mean"] and leaky["cv_f1_std"] >= 0


def test_bagged_forest_in_the_stages(spark, data):
    feats = [*X.FEATURES, "code"]
    models = stages.train_models(data["balanced"], "k", feats, "failure", trees=6, out_of_bag=True)
    cv = spark.createDataFrame([("Bosque Aleatorio", 0.91234, 0.01)], "model string, cv_f1_mean double, cv_f1_std double")
    made = stages.evaluate(models, data["test"], "k", feats, "failure", cv=cv, balanced=data["balanced"])
    got = {r["model"]: r for r in made.collect()}
    forest = got["Bosque Aleatorio"]
    assert len(got) == 3 and 0.8 < forest["oob_score"] < 1 and forest["auc_roc"] > 0.9
    assert forest["cv_f1_mean"] == 0.9123 and got["Regresión Logística"]["cv_f1_mean"] is None
    assert sum(forest["feature_importance"].values()) == pytest.approx(1, abs=1e-3) and forest["hiperparametros"]["n_estimators"] == "6"


def test_csv_with_padded_header(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        "UDI, Type ,Air temperature [K],Process temperature [K],Rotational speed [rpm],Torque [Nm],Tool wear [min],Machine failure,TWF,HDF,PWF,OSF,RNF \n"
        "1,M,298.1,308.6,1551,42.8,0,0,0,0,0,0,0\n2,L,298.2,,1408,46.3,3,1,0,1,0,0,0\n3,H,298.3,308.7,1498,49.4,NaN,0,0,0,0,0,0\n"
    )
    df = src.load_readings(spark, str(path)).orderBy("UDI")
    types = dict(df.dtypes)
    assert types["temp_aire"] == "double" and types["vel_rotacion"] == "int" and types["Type"] == "string" and types["UDI"] == "string"
    rows = df.collect()
    assert [r["tipo_cod"] for r in rows] == [2, 1, 0]  # sorted: H, L, M
    assert rows[1]["temp_proceso"] is None and rows[1]["diff_temp"] is None and rows[2]["desgaste"] is None
    assert rows[0]["potencia_w"] == pytest.approx(42.8 * 1551 * 2 * np.pi / 60)
    with pytest.raises(FileNotFoundError):
        src.read_readings(spark, str(tmp_path / "none.csv"))
    bad = tmp_path / "bad.csv"
    bad.write_text("Type,Torque [Nm]\nL,4x\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        src.read_readings(spark, str(bad)).collect()


def test_trim_json(spark):
    doc = '{" a ": [" x ", {"b ": "  y\\n", "n": 1.5}], "c": null}'
    got = src.trim_json(spark.createDataFrame([(doc,), (None,)], "d string"), "d").collect()
    assert got[0]["d"] == '{"a": ["x", {"b": "y", "n": 1.5}], "c": null}' and got[1]["d"] is None


def test_trim_json_of_any_shape(spark):
    def clean(v):
        if isinstance(v, dict):
            return {k.strip(): clean(x) for k, x in v.items()}
        return [clean(x) for x in v] if isinstance(v, list) else v.strip() if isinstance(v, str) else v

    blanks = [chr(c) for c in (9, 10, 11, 12, 13, 28, 31, 32, 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x202F, 0x205F, 0x3000)]
    odd = ["", " ", "a\\b", ' "q" ', "back\\ ", "\u00e9 x", "  " + "long word " * 50_000]
    values = [*odd, *[b + "x" + b + "y" + b for b in blanks], {" k ": [1, None, {"": " z "}]}, [[], {}, " w "], 1.5, None, True]
    docs = [json.dumps(v, ensure_ascii=e) for v in [*values, values, {b + "k" + b: b for b in blanks}] for e in (True, False)]
    got = src.trim_json(spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, d string"), "d")
    assert "Python" not in got._jdf.queryExecution().toString() and "Arrow" not in got._jdf.queryExecution().toString()
    for r in got.collect():
        assert json.loads(r["d"]) == clean(json.loads(docs[r["i"]]))
    with pytest.raises(Exception, match="not JSON"):
        src.trim_json(spark.createDataFrame([('{"a": ',)], "d string"), "d").collect()


def test_integers_keep_all_digits(spark, tmp_path):
    path, types = tmp_path / "n.csv", {"a": T.LongType()}
    path.write_text("a\n9007199254740993\n9223372036854775807\n-9223372036854775808\n9007199254740993.0\n1e3\n 7 \nNA\n")
    assert [r["a"] for r in src.read_readings(spark, str(path), types).collect()] == [2**53 + 1, 2**63 - 1, -(2**63), 2**53 + 1, 1000, 7, None]
    for bad in ("9223372036854775808", "1.5", "1e-20", "9007199254740993.5"):
        path.write_text(f"a\n{bad}\n")
        with pytest.raises(Exception, match="not an integer|OVERFLOW"):
            src.read_readings(spark, str(path), types).collect()


def test_publication_is_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "made")
    one, two = (spark.createDataFrame([(k,)], "k string") for k in ("old", "new"))
    with pytest.raises(FileNotFoundError):
        store.read_processed(spark, path)
    store.write_processed(path, one, one, ["x"])

    def fails(to):
        raise OSError("lost")

    with pytest.raises(OSError):  # between the parts
        store.publish(spark, path, {"train": two.write.parquet, "test": fails})
    tr, te, names = store.read_processed(spark, path)
    assert [r["k"] for r in tr.unionByName(te).collect()] == ["old", "old"] and names == ["x"]
    for n, part in ((2, two), (3, two)):
        assert store.write_processed(path, part, part, ["y"]) == n
    tr, te, names = store.read_processed(spark, path)
    assert [r["k"] for r in tr.unionByName(te).collect()] == ["new", "new"] and names == ["y"]
    assert sorted(p.name for p in (tmp_path / "made" / "versions").iterdir()) == ["2", "3"]  # the oldest is gone
    store.write_json(one, path + "-doc")
    store.write_json(two, path + "-doc")
    assert store.read_json(spark, path + "-doc", two.schema).first()["k"] == "new"


def test_processed_round_trip(spark, tmp_path):
    a = spark.createDataFrame([("k1", 0.5, 1)], "k string, x double, y int")
    store.write_processed(str(tmp_path), a, a, ["x"])
    tr, te, names = store.read_processed(spark, str(tmp_path))
    assert tr.collect() == a.collect() == te.collect() and names == ["x"]
    with pytest.raises(FileNotFoundError):
        store.read_processed(spark, str(tmp_path / "none"))


def test_records_carry_what_training_produced(spark, data, models):
    features = [*X.FEATURES, "code"]
    made = stages.evaluate(models, data["test"], "k", features, "failure", oob={"Bosque Aleatorio": 0.9})
    got = {r["model"]: r for r in made.collect()}
    tree, forest, line = (got[m] for m in models)
    assert sum(tree["feature_importance"].values()) == pytest.approx(1, abs=1e-3) and set(forest["feature_importance"]) == set(features)
    assert tree["num_hojas"] == train.tree_shape(spark, models["Árbol de Decisión"]).first()["leaves"] and tree["profundidad_real"] <= 6
    assert forest["oob_score"] == 0.9 and forest["hiperparametros"]["n_estimators"] == "10" and forest["num_hojas"] is None
    assert line["feature_importance"] is None and set(line["coeficientes"]) == set(features) and line["intercepto"] is not None
    out = stages.published(made, meta={"dataset": "d", "_note": "x"})
    assert out["dashboard"].first()["meta"] == {"dataset": "d"} and out["record"].first()["modelos"]["Bosque Aleatorio"]["oob_score"] == 0.9
    ranks = out["report"].where("section = 'importance' AND model = 'Bosque Aleatorio'").orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == [1, 2, 3, 4, 5, 6] and [float(r["value"]) for r in ranks] == sorted(forest["feature_importance"].values(), reverse=True)
    assert {r["name"] for r in out["report"].where("section = 'run'").collect()} == {"dataset", "mejor_modelo", "recall_minimo", "hipotesis"}


def test_profile_stage(spark):
    out = stages.profiled(X.readings(spark, DIR), X.FEATURES, "failure", X.MODES, X.RULES, ("f2",))
    assert {k: v.count() for k, v in out.items()} == {
        "classes": 1, "modes": 5, "contrast": 5, "describe": 5, "intervals": 25, "zones": 5, "rules": 5, "target": 5, "pairs": out["pairs"].count()}
