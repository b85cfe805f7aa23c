"""Registered queries: each reads the given tables through the stand-in views, whole."""

import uuid
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixture as X
from checks import parts as P
from checks.parts import LABEL, rounded
from upkeep import defaults as D
from upkeep.functions import scalars as S
from upkeep.operators import charts, choose, columns, correlation, evaluate, infer, prep, profile, publish, train, trees
from upkeep.operators.bounds import settle, shared_dir, spread
from upkeep.operators.neighbours import listed_rows, nearest_neighbours, unlisted_rows
from upkeep.plans import stages
from upkeep.sources import readings as src
from upkeep.sources import store
from upkeep.streaming import live

FE = X.FEATURES
Q = {}


def query(name):
    def add(fn):
        Q[name] = fn
        return fn

    return add


def scratch(spark):
    folder = shared_dir(spark)
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{folder.rstrip('/')}/scratch-{uuid.uuid4().hex}"


def R(spark, d):
    return X.readings(spark, d)


def flat(spark, d):
    order = F.create_map(*[x for i, m in enumerate(X.MODELS) for x in (F.lit(m), F.lit(i))])
    made = X.once(spark, d, "flat", lambda: settle(evaluate.flat_metrics(X.scored(spark, d), LABEL)))
    return made.withColumn("ordinal", order[F.col("model")])


def records(spark, d):
    order = F.create_map(*[x for i, m in enumerate(X.MODELS) for x in (F.lit(m), F.lit(i))])
    made = X.once(spark, d, "records", lambda: settle(evaluate.evaluate_models(X.scored(spark, d), LABEL)))
    return made.withColumn("ordinal", order[F.col("model")])


# --- sources and sinks ---

@query("S1_read_readings")
def _(spark, d):
    path = scratch(spark)
    padded = R(spark, d).select(F.col("k").alias(" k"), F.col("kind").alias("Type "), *[F.col(c).alias(f" {c} ") for c in FE], LABEL)
    padded.write.csv(path, header=True)
    types = {**{c: T.DoubleType() for c in FE}, LABEL: T.IntegerType()}
    return src.read_readings(spark, path, types)


@query("S2_rename_columns")
def _(spark, d):
    names = {**{v: k for k, v in X.ROLES.items()}, "absent": "x", LABEL: "falla"}
    out = columns.rename_columns(R(spark, d), names).groupBy("falla").agg(*[F.avg(c).alias(c) for c in X.ROLES])
    return rounded(out)


@query("S3_require_columns")
def _(spark, d):
    return columns.require_columns(R(spark, d), [*FE, LABEL]).groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"))


@query("S4_dataset_summary")
def _(spark, d):
    holed = R(spark, d).withColumn("f1", F.when(F.col("f1") > 2, F.col("f1")))
    return rounded(profile.dataset_summary(holed, LABEL))


@query("S5_schema_profile")
def _(spark, d):
    return profile.schema_profile(R(spark, d))


@query("S6_preview")
def _(spark, d):
    return profile.preview(R(spark, d), "k", [*FE, LABEL], 8)


@query("S7_write_read_processed")
def _(spark, d):
    path = scratch(spark)
    store.write_processed(path, P.balanced(spark, d), P.scaled(spark, d, "test"), P.CODED)
    tr, te, names = store.read_processed(spark, path)
    counts = tr.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("train")).unionByName(
        te.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("test")))
    return counts.withColumn("features", F.lit(",".join(names)))


@query("S8_save_load_model")
def _(spark, d):
    path = scratch(spark)
    store.save_model(train.with_scaler(P.logistic(spark, d), P.scaler(spark, d), P.CODED), path)
    model = store.load_model(spark, path)
    return rounded(train.score(model, P.split(spark, d).where("split = 'test'"), ["k", LABEL]))


@query("S8_saved_scaler")
def _(spark, d):
    path = scratch(spark)
    store.save_model(train.with_scaler(P.logistic(spark, d), P.scaler(spark, d), P.CODED), path)
    out = store.load_model(spark, path).transform(P.split(spark, d).where("split = 'test'"))
    return rounded(out.select("k", *[vector_to_array("features")[i].alias(f) for i, f in enumerate(P.CODED)]), 5)


@query("S9_write_stats_csv")
def _(spark, d):
    path = scratch(spark)
    out = profile.class_contrast(R(spark, d), FE, LABEL)
    store.write_stats_csv(out, path)
    return rounded(spark.read.schema(out.schema).csv(path, header=True))


@query("S10_metrics_json")
def _(spark, d):
    path = scratch(spark)
    doc = publish.run_record(records(spark, d), {"dataset": "readings", "_comment": "left out"})
    store.write_json(doc, path)
    back = store.read_json(spark, path, doc.schema)
    rows = back.select("mejor_modelo", "hipotesis_verificada", F.explode("modelos").alias("model", "m"))
    return rounded(rows.select("model", "mejor_modelo", "hipotesis_verificada", "m.recall", "m.confusion_matrix.tp", "m.confusion_matrix.fp"))


@query("S11_trim_json")
def _(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet")
    padded = events.select("event_id", F.create_map(
        F.lit(" kind "), F.concat(F.lit("  "), "event_type", F.lit(" ")), F.lit("k"), F.get_json_object("props", "$.k")
    ).alias("m"))
    trimmed = padded.withColumn("m", S.trim_map("m"))
    return trimmed.select("event_id", F.col("m")["kind"].alias("kind"), F.col("m")["k"].alias("k"))


@query("S11_trim_json_deep")
def _(spark, d):
    events = spread(spark.read.parquet(f"{d}/events.parquet").select("event_id", "event_type", "props"), "event_id")
    doc = F.concat(F.lit('{" a ": {"b ": [" '), "event_type", F.lit(' ", 1]}, "props": '), "props", F.lit("}"))
    trimmed = src.trim_json(events.select("event_id", doc.alias("doc")), "doc")
    return trimmed.select("event_id", F.get_json_object("doc", "$.a.b[0]").alias("kind"), F.get_json_object("doc", "$.props.k").alias("k"))


# --- rows ---

@query("F1_encode_category")
def _(spark, d):
    return columns.encode_category(R(spark, d), "kind", "code").select("k", "code")


@query("F2_add_temp_diff")
def _(spark, d):
    return rounded(columns.add_temp_diff(R(spark, d), "f3", "f4", "temp_diff").select("k", "temp_diff"))


@query("F3_add_power_w")
def _(spark, d):
    return rounded(columns.add_power_w(R(spark, d), "f1", "f2", "power_w").select("k", "power_w"), 3)


@query("F4_select_features")
def _(spark, d):
    out = columns.select_features(R(spark, d), "k", FE, LABEL, as_vector=False)
    return out.select("k", *[F.col("features")[i].alias(f) for i, f in enumerate(FE)], F.col("label").cast("int").alias("label"))


@query("F4_class_counts")
def _(spark, d):
    return prep.class_sizes(R(spark, d), LABEL)


@query("F5_by_class")
def _(spark, d):
    return columns.by_class(R(spark, d), 1, LABEL).select("k", *FE)


@query("F6_by_mode")
def _(spark, d):
    return rounded(columns.by_mode(R(spark, d), [*X.MODES, "absent"]).select("mode", "k", "f1"))


@query("F7_failure_mode_index")
def _(spark, d):
    return columns.with_mode_index(R(spark, d), X.MODES, "mode_index").select("k", "mode_index")


@query("F8_flag_risk_zone")
def _(spark, d):
    return columns.flag_risk_zone(R(spark, d), X.RULES).select("k", *[f"{r[0]}_risk" for r in X.RULES], "risk_count")


@query("F9_significance_stars")
def _(spark, d):
    return R(spark, d).select("k", S.significance_stars(F.col("f3")).alias("stars"))


@query("F10_corr_strength")
def _(spark, d):
    r = (F.col("f1") - 25) / 25
    return R(spark, d).select("k", S.corr_strength(r).alias("strength")).where("strength IS NOT NULL")


@query("F11_sign_tag")
def _(spark, d):
    return R(spark, d).select("k", S.sign_tag(F.col("f3") - F.lit(0.05)).alias("tag"))


@query("F12_verdict")
def _(spark, d):
    return R(spark, d).select("k", S.verdict(F.col(LABEL) == 0).alias("verdict"))


@query("F13_drop_meta_keys")
def _(spark, d):
    m = F.create_map(F.lit("_comment"), F.col("kind"), F.lit("k"), F.col("k"), F.concat(F.lit("x"), "kind"), F.lit("v"))
    return R(spark, d).select("k", F.array_join(F.array_sort(F.map_keys(S.drop_meta_keys(m))), ",").alias("keys"))


# --- profiles ---

@query("A1_class_distribution")
def _(spark, d):
    return rounded(profile.class_distribution(R(spark, d), LABEL))


@query("A2_mode_frequency")
def _(spark, d):
    return rounded(profile.mode_frequency(R(spark, d), [*X.MODES, "absent"]))


@query("A3_class_stats")
def _(spark, d):
    return rounded(profile.class_stats(R(spark, d), FE, LABEL))


@query("A4_class_contrast")
def _(spark, d):
    return rounded(profile.class_contrast(R(spark, d), FE, LABEL), 5)


@query("A5_describe_features")
def _(spark, d):
    return rounded(profile.describe_features(R(spark, d), FE), 7)


@query("A6_mode_intervals")
def _(spark, d):
    return rounded(profile.mode_intervals(R(spark, d), FE, X.MODES))


@query("A7_failure_q1_zones")
def _(spark, d):
    return rounded(profile.failure_q1_zones(R(spark, d), FE, LABEL, falling=("f2",)))


def _validated(spark, d):
    return profile.validate_intervals(R(spark, d), X.RULES, LABEL)


@query("A8_validate_intervals")
def _(spark, d):
    return rounded(_validated(spark, d))


@query("A9_intervals_concordant")
def _(spark, d):
    return profile.intervals_concordant(_validated(spark, d))


@query("A10_rate_by_category")
def _(spark, d):
    return rounded(profile.rate_by_category(R(spark, d), "kind", LABEL))


@query("A10_rate_by_source")
def _(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "source")
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "toxic")
    return rounded(profile.rate_by_category(labels.join(docs, "doc_id"), "source", "toxic"))


@query("A11_split_report")
def _(spark, d):
    return rounded(profile.split_report(P.split(spark, d), LABEL))


@query("A12_balance_report")
def _(spark, d):
    return rounded(profile.balance_report(P.balanced(spark, d), LABEL))


@query("A13_prep_summary")
def _(spark, d):
    out = profile.prep_summary(R(spark, d), P.split(spark, d), P.balanced(spark, d), P.CODED, LABEL, dataset="readings")
    return out.select(
        "total", F.array_join("features", ",").alias("features"), "test_size", "seed", "split.*",
        F.col("smote.normal").alias("bal_normal"), F.col("smote.failures").alias("bal_failures"), F.col("smote.created").alias("created"),
    )


# --- correlation and inference ---

@query("C1_corr_with_target")
def _(spark, d):
    return rounded(correlation.corr_with_target(R(spark, d), FE, LABEL))


@query("C2_corr_with_target_signed")
def _(spark, d):
    return rounded(correlation.corr_with_target_signed(R(spark, d), FE, LABEL))


@query("C3_corr_matrix")
def _(spark, d):
    return rounded(correlation.corr_matrix(R(spark, d), [*FE, LABEL]))


@query("C3_corr_matrix_wide")
def _(spark, d):
    return rounded(correlation.corr_matrix(R(spark, d), FE, wide=True))


@query("C4_corr_pairs")
def _(spark, d):
    more = R(spark, d).withColumn("f6", F.col("f1") * F.col("f2")).withColumn("f7", -F.col("f1"))
    return rounded(correlation.corr_pairs(more, [*FE, "f6", "f7"]))


@query("C5_top_corr")
def _(spark, d):
    return rounded(correlation.top_corr(R(spark, d), ("f1", "f2"), FE, LABEL))


@query("T1_t_test_by_class")
def _(spark, d):
    out = infer.t_statistics(infer.class_moments(R(spark, d), FE, LABEL))
    return rounded(out.select("variable", "n0", "n1", "mean0", "mean1", "t", "df"), 5)


@query("T1_p_values")
def _(spark, d):
    return rounded(infer.t_test_by_class(R(spark, d), FE, LABEL).select("variable", "p", "stars"), 5)


# --- chart data ---

@query("H1_histogram_by_class")
def _(spark, d):
    return rounded(charts.histogram_by_class(R(spark, d), FE, LABEL))


@query("H2_histogram_by_category")
def _(spark, d):
    return rounded(charts.histogram_by_category(R(spark, d), "f5", "kind", LABEL))


@query("H3_boxplot_stats")
def _(spark, d):
    return rounded(charts.boxplot_stats(R(spark, d), FE, LABEL))


@query("H4_scatter_bins")
def _(spark, d):
    return rounded(charts.scatter_bins(R(spark, d), "f2", "f1", LABEL, 50))


@query("H4_scatter_by_mode")
def _(spark, d):
    return rounded(charts.scatter_by_mode(R(spark, d), "f5", "f4", X.MODES, 20))


@query("H4_scatter_sample")
def _(spark, d):
    return charts.scatter_sample(R(spark, d), "k", ["f1", "f2", LABEL], 0.05)


@query("H5_metric_table_long")
def _(spark, d):
    return rounded(charts.metric_table_long(flat(spark, d)))


@query("H6_importance_ranked")
def _(spark, d):
    size = correlation.corr_with_target(R(spark, d), FE, LABEL).select("variable", F.col("abs_r").alias("importance"))
    return rounded(charts.importance_ranked(size))


@query("H7_best_per_metric")
def _(spark, d):
    return rounded(charts.best_per_metric(flat(spark, d)))


@query("H8_kpis")
def _(spark, d):
    return rounded(charts.kpis(profile.dataset_summary(R(spark, d), LABEL), choose.select_best(flat(spark, d))))


# --- preparation ---

@query("P1_stratified_split")
def _(spark, d):
    return prep.stratified_split(R(spark, d).select("k", LABEL), "k", LABEL)


@query("P2_apply_scaler")
def _(spark, d):
    return P.scaled(spark, d, "test").select("k", *P.CODED)


@query("P3_scaler_params")
def _(spark, d):
    return rounded(prep.scaler_params(prep.fit_scaler(P.train_raw(spark, d), P.CODED)))


@query("P4_nearest_neighbours")
def _(spark, d):
    minority = P.scaled(spark, d, "train").where(F.col(LABEL) == 1)
    found = nearest_neighbours(minority, "k", P.CODED, 5)
    places = settle(found.select("x", "keys", F.transform("near", lambda n: F.struct(n["key"].alias("key"))).alias("near")))
    rows = listed_rows(places, 5).unionByName(unlisted_rows(minority, places, "k", P.CODED, 5))
    return rows.select(F.col("key").alias("k"), F.posexplode("near").alias("place", "n")).select("k", "place", F.col("n.key").alias("neighbour"))


@query("P4_smote")
def _(spark, d):
    return P.balanced(spark, d)


@query("P5_class_weights")
def _(spark, d):
    return rounded(prep.class_weights(P.train_raw(spark, d), LABEL))


@query("P6_stratified_folds")
def _(spark, d):
    return prep.stratified_folds(R(spark, d).select("k", LABEL), "k", LABEL)


# --- training and scoring ---

@query("M1_decision_tree")
def _(spark, d):
    return train.score(P.tree(spark, d), P.test_rows(spark, d), ["k", "label"], D.TREE)


@query("M1_best_split")
def _(spark, d):
    """The two leaves of a tree of depth 1, classes weighed alike, on the raw features of few values."""
    few = ["f1", "f3", "f4", "f5"]
    rows = columns.select_features(R(spark, d), "k", few, LABEL)
    stump = train.fit_decision_tree(rows, max_depth=1)
    at = int(stump.featureImportances.toArray().argmax())
    value = vector_to_array("features")[at]
    out = stump.transform(rows).groupBy(vector_to_array("probability")[1].alias("probability"), F.col("prediction").cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("failures"), F.min(value).alias("lo"), F.max(value).alias("hi"))
    return rounded(out.withColumn("variable", F.lit(few[at])))


@query("M2_random_forest")
def _(spark, d):
    return train.score(P.forest(spark, d), P.test_rows(spark, d), ["k", "label"], D.FOREST)


@query("M3_logistic_regression")
def _(spark, d):
    return train.score(P.logistic(spark, d), P.test_rows(spark, d), ["k", "label"], D.LOGISTIC)


@query("M3_gradient")
def _(spark, d):
    """Slope of the penalised loss at the fitted coefficients, over all balanced rows: zero at the optimum."""
    model = P.logistic(spark, d)
    rows, n = P.balanced(spark, d), P.balanced(spark, d).count()
    w = dict(zip(P.CODED, model.coefficients.toArray().tolist()))
    z = sum((F.col(f) * w[f] for f in P.CODED), F.lit(float(model.intercept)))
    error = F.try_divide(F.lit(1.0), 1 + F.exp(-z)) - F.col(LABEL)
    slopes = F.array(*[
        F.struct(F.lit(f).alias("variable"), (F.avg(error * F.col(f)) + F.lit(w[f] / n)).alias("slope")) for f in P.CODED
    ])
    return rounded(rows.agg(slopes.alias("e")).select(F.inline("e")), 3)


@query("M4_tree_shape")
def _(spark, d):
    return train.tree_shape(spark, P.tree(spark, d))


@query("M4_leaves_reached")
def _(spark, d):
    """Leaves of the fitted tree that no row of the training table falls in, and how far the counts are from a binary tree's."""
    tree = P.tree(spark, d).copy().setLeafCol("leaf")
    reached = tree.transform(P.ready(spark, d)).agg(F.count_distinct("leaf").alias("reached"), F.count(F.lit(1)).alias("n")).first()
    shape = train.tree_shape(spark, tree)
    return shape.select(F.lit(reached["n"]).alias("n"), (F.col("leaves") - F.lit(reached["reached"])).alias("empty_leaves"),
                        (F.col("leaves") - F.col("inner_nodes")).alias("more_leaves"), (F.col("depth") <= D.TREE_DEPTH).alias("within_depth"))


@query("M5_feature_importance")
def _(spark, d):
    return train.feature_importance(spark, P.forest(spark, d), P.CODED)


@query("M5_importance_total")
def _(spark, d):
    out = train.feature_importance(spark, P.forest(spark, d), P.CODED)
    return rounded(out.agg(F.count(F.lit(1)).alias("n"), F.sum("importance").alias("total")))


@query("M6_coefficients")
def _(spark, d):
    return train.coefficients(spark, P.logistic(spark, d), P.CODED)


@query("M6_newton_step")
def _(spark, d):
    rows = columns.select_features(P.balanced(spark, d), "k", P.CODED, LABEL, as_vector=False)
    return train.newton_step(P.logistic(spark, d), rows, P.CODED).select("variable", (F.round("step", 3) + F.lit(0.0)).alias("step"))


@query("M6_coefficients_of_two")
def _(spark, d):
    model = train.fit_logistic_regression(P.pair_rows(spark, d), tol=1e-12)
    return train.coefficients(spark, model, P.PAIR).select("rank", "variable", F.round("coefficient", 3).alias("coefficient"), "sign", F.round("intercept", 3).alias("intercept"))


@query("M7_convergence")
def _(spark, d):
    return train.convergence(spark, P.logistic(spark, d))


@query("M7_converged")
def _(spark, d):
    return train.convergence(spark, P.logistic(spark, d)).select("max_iterations", "converged")


@query("M9_set_params")
def _(spark, d):
    return train.model_params(spark, P.tree(spark, d)).where(F.col("param").isin("maxDepth", "impurity", "seed", "weightCol"))


@query("M8_oob_score")
def _(spark, d):
    return train.oob_score(P.ready(spark, d), "k")


@query("M2_bagged_trees")
def _(spark, d):
    name = F.array(*[F.lit(c) for c in P.SHORT])
    return P.small_forest(spark, d).nodes.select(
        "tree", "path", F.when(F.col("feature") >= 0, F.get(name, F.col("feature"))).alias("variable"), F.round("threshold", 6).alias("threshold"),
        F.round("n0", 3).alias("c0"), F.round("n1", 3).alias("c1"), F.round("p", 6).alias("p"))


@query("M2_forest_nodes")
def _(spark, d):
    return P.forest_nodes(spark, d).drop("parents")


@query("M2_leaf_boxes")
def _(spark, d):
    return trees.leaf_boxes(P.forest_nodes(spark, d))


@query("M5_importance_from_data")
def _(spark, d):
    nodes = P.small_forest(spark, d).nodes
    return rounded(trees.importances(nodes, trees.node_counts(nodes, P.bags(spark, d)), P.SHORT))


@query("M8_out_of_bag")
def _(spark, d):
    ready = columns.select_features(P.train_raw(spark, d), "k", P.SHORT, LABEL)
    return rounded(P.small_forest(spark, d).out_of_bag(ready, "k").withColumn("label", F.col("label").cast("int")))


@query("M8_oob_of_forest")
def _(spark, d):
    ready = columns.select_features(P.train_raw(spark, d), "k", P.SHORT, LABEL)
    return rounded(P.small_forest(spark, d).oob_score(ready, "k"))


@query("M9_records_of_training")
def _(spark, d):
    """What the bagged forest and the tree leave in a model's record, out-of-bag score and cross-validation included."""
    cv = evaluate.cv_summary(evaluate.fold_f1(X.scored(spark, d).join(prep.stratified_folds(R(spark, d).select("k", LABEL), "k", LABEL).select("k", "fold"), "k"), LABEL))
    cv = cv.withColumn("model", F.when(F.col("model") == "rule_a", "forest").otherwise(F.col("model")))
    ready = columns.select_features(P.train_raw(spark, d), "k", P.SHORT, LABEL)
    forest = P.small_forest(spark, d)
    made = train.model_records(spark, {"forest": forest}, P.SHORT, {"forest": forest.oob_score(ready, "k").first()["oob_accuracy"]}, cv)
    shares = F.array_sort(F.map_entries("feature_importance"))
    return made.select("model", F.array_join(F.transform(shares, lambda e: F.concat_ws("=", e["key"], F.format_string("%.4f", e["value"]))), ",").alias("shares"), F.round("oob_score", 6).alias("oob_score"),
                       F.col("hiperparametros")["n_estimators"].alias("trees"), "cv_f1_mean", "cv_f1_std")


@query("X1_table_scores")
def _(spark, d):
    test = P.split(spark, d).where("split = 'test'")
    return rounded(P.small_forest(spark, d).score(columns.select_features(test, "k", P.SHORT, LABEL, as_vector=False), ["k"]))


@query("X1_table_equals_model")
def _(spark, d):
    """Test rows whose score by the node table is not the model's, of the tree and the forest of all trees."""
    rows = columns.select_features(P.scaled(spark, d, "test"), "k", P.CODED, LABEL, as_vector=False)
    tables = {"tree": trees.tree_nodes(P.tree(spark, d)), "forest": P.forest_nodes(spark, d)}
    mine = reduce(DataFrame.unionByName, [trees.score_nodes(n, rows, ["k"]).withColumn("model", F.lit(m)) for m, n in tables.items()])
    both = mine.alias("a").join(P.model_scores(spark, d).where("model <> 'logistic'").alias("b"), ["k", "model"], "full")
    near = (F.col("a.prediction") == F.col("b.prediction")) & (F.abs(F.col("a.probability") - F.col("b.probability")) < 1e-9)
    return both.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(near, F.lit(False))).alias("differing"))


@query("M9_model_params")
def _(spark, d):
    return train.model_params(spark, P.tree(spark, d))


@query("X1_score")
def _(spark, d):
    model = train.with_scaler(P.forest(spark, d), P.scaler(spark, d), P.CODED)
    return train.score(model, P.split(spark, d), ["k", LABEL])


@query("X1_prediction_rule")
def _(spark, d):
    """Test rows scored by each model, and how many break the rule: class 1 above one half, probabilities from 0 to 1."""
    p = F.col("probability")
    fine = p.between(0, 1) & (F.col("prediction") == (p > 0.5).cast("int"))
    return P.model_scores(spark, d).groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("failures"), F.count_if(~fine).alias("broken"))


@query("X1_score_stream")
def _(spark, d):
    source, sink, mark = scratch(spark), scratch(spark), scratch(spark)
    P.split(spark, d).where("split = 'test'").write.parquet(source)
    model = train.with_scaler(P.tree(spark, d), P.scaler(spark, d), P.CODED)
    stream = live.stream_readings(spark, source, P.split(spark, d).schema)
    out = live.score_stream(model, stream, ["k", LABEL])
    live.write_stream(out, sink, mark)
    return spark.read.schema(out.schema).parquet(sink)


@query("X1_stream_equals_batch")
def _(spark, d):
    source, sink, mark = scratch(spark), scratch(spark), scratch(spark)
    test = P.split(spark, d).where("split = 'test'")
    test.write.parquet(source)
    model = train.with_scaler(P.tree(spark, d), P.scaler(spark, d), P.CODED)
    live.write_stream(live.score_stream(model, live.stream_readings(spark, source, test.schema), ["k"]), sink, mark)
    both = train.score(model, test, ["k"]).alias("a").join(spark.read.parquet(sink).alias("b"), "k", "full")
    same = F.col("a.prediction").eqNullSafe(F.col("b.prediction")) & F.col("a.probability").eqNullSafe(F.col("b.probability"))
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(~same).alias("differing"))


@query("F8_risk_stream")
def _(spark, d):
    source, sink, mark = scratch(spark), scratch(spark), scratch(spark)
    events = spark.read.parquet(f"{d}/events.parquet").select("event_id", "event_type", "value")
    events.write.parquet(source)
    out = live.risk_stream(live.stream_readings(spark, source, events.schema), [("value", ">", 20.0, "u")])
    live.write_stream(out, sink, mark)
    return spark.read.schema(out.schema).parquet(sink).select("event_id", "value_risk", "risk_count")


# --- evaluation ---

@query("V1_confusion")
def _(spark, d):
    return evaluate.confusion(X.scored(spark, d), LABEL).select(
        "model", "tn", "fp", "fn", "tp", F.array_join(F.flatten("matrix"), ",").alias("matrix"))


@query("V2_binary_metrics")
def _(spark, d):
    return rounded(evaluate.binary_metrics(evaluate.confusion(X.scored(spark, d), LABEL)).drop("matrix"))


@query("V3_roc_auc")
def _(spark, d):
    return rounded(evaluate.roc_auc(X.scored(spark, d), LABEL))


@query("V4_roc_curve")
def _(spark, d):
    return rounded(evaluate.roc_curve(X.scored(spark, d), LABEL))


@query("V5_per_class_report")
def _(spark, d):
    return rounded(evaluate.per_class_report(evaluate.confusion(X.scored(spark, d), LABEL)))


@query("V6_fold_f1")
def _(spark, d):
    folds = prep.stratified_folds(R(spark, d).select("k", LABEL), "k", LABEL)
    return rounded(evaluate.fold_f1(X.scored(spark, d).join(folds.select("k", "fold"), "k"), LABEL))


@query("V6_cv_summary")
def _(spark, d):
    folds = prep.stratified_folds(R(spark, d).select("k", LABEL), "k", LABEL)
    return rounded(evaluate.cv_summary(evaluate.fold_f1(X.scored(spark, d).join(folds.select("k", "fold"), "k"), LABEL)))


@query("V6_cv_f1")
def _(spark, d):
    fits = {D.TREE: train.fit_decision_tree, D.FOREST: train.fit_random_forest, D.LOGISTIC: train.fit_logistic_regression}
    return stages.cross_validated(P.balanced(spark, d), "k", fits, P.CODED, LABEL)


@query("V7_hypothesis_check")
def _(spark, d):
    return rounded(evaluate.hypothesis_check(flat(spark, d)))


@query("V8_all_models_pass")
def _(spark, d):
    return evaluate.all_models_pass(evaluate.hypothesis_check(flat(spark, d)))


@query("V9_evaluate_models")
def _(spark, d):
    r = records(spark, d)
    return rounded(r.select(
        "model", "accuracy", "precision", "recall", "f1", "auc_roc", "confusion_matrix.tn", "confusion_matrix.fp",
        "confusion_matrix.fn", "confusion_matrix.tp", F.col("por_clase")["Normal"]["recall"].alias("recall_normal"),
        F.col("por_clase")["Falla"]["support"].alias("support_failure"), F.col("hipotesis.verificada").alias("verified"),
    ), 4)


@query("V9_roc_all_points")
def _(spark, d):
    made = evaluate.evaluate_models(X.scored(spark, d), LABEL, roc="all")
    return made.select("model", F.size("curva_roc.fpr").alias("points"), F.size("curva_roc.tpr").alias("points_tpr"))


@query("V9_evaluate_trained")
def _(spark, d):
    return evaluate.flat_metrics(P.model_scores(spark, d)).drop("matrix")


@query("V10_merge_previous_metrics")
def _(spark, d):
    previous = flat(spark, d).where("model != 'rule_c'").select(
        "model", F.when(F.col("model") == "rule_a", F.col("f1")).alias("cv_f1_mean"), (F.col("f1") / 10).alias("cv_f1_std"))
    return rounded(evaluate.merge_previous_metrics(flat(spark, d).select("model", "f1", "cv_f1_mean", "cv_f1_std"), previous))


# --- choice ---

@query("Q1_select_best")
def _(spark, d):
    return rounded(choose.select_best(flat(spark, d)).select("model", "recall", "f1", "auc_roc"))


@query("Q2_best_by_f1")
def _(spark, d):
    return rounded(choose.best_by_f1(flat(spark, d)))


@query("Q2_best_by_auc")
def _(spark, d):
    return rounded(choose.best_by_auc(flat(spark, d)))


@query("Q3_ranked_comparison")
def _(spark, d):
    return rounded(choose.ranked_comparison(flat(spark, d)))


@query("Q4_top_k")
def _(spark, d):
    return rounded(choose.top_k(correlation.corr_with_target(R(spark, d), FE, LABEL), "r", 3, "variable", size=True))


# --- published tables ---

@query("R1_metrics_table")
def _(spark, d):
    return rounded(publish.metrics_table(records(spark, d)), 4)


@query("R2_dashboard_payload")
def _(spark, d):
    info = publish.dataset_info(R(spark, d), LABEL, X.MODES, doi="10.1/readings")
    doc = publish.dashboard_payload(records(spark, d), info, X.RULES, meta={"dataset": "readings", "_comment": "left out"})
    return doc.select(
        F.col("mejor_modelo").alias("best"), F.col("hipotesis.verificada").alias("verified"), F.col("hipotesis.mejor_recall").alias("recall"),
        F.array_join("comparacion.nombres", ",").alias("names"), F.col("dataset.total_registros").alias("total"),
        F.array_join(F.transform("comparacion.f1", lambda v: F.format_string("%.4f", v)), ",").alias("f1s"),
        F.col("confusion_matrices")["rule_b"]["fn"].alias("rule_b_fn"), F.size(F.col("roc_curves")["rule_c"]["fpr"]).alias("rule_c_points"),
        F.col("hipotesis.intervalos")["f2_rpm"].alias("f2_rule"), F.to_json("meta").alias("meta"), F.col("dataset.doi").alias("doi"),
    )


@query("R4_trained_report")
def _(spark, d):
    """Report of the trained models: their importances by rank, and their cells on the test rows."""
    models = {D.TREE: P.tree(spark, d), D.FOREST: P.forest(spark, d), D.LOGISTIC: P.logistic(spark, d)}
    made = stages.evaluate(models, P.scaled(spark, d, "test"), "k", P.CODED, LABEL)
    rows = settle(stages.published(made, rules=X.RULES)["report"])
    imp = rows.where("section = 'importance'").withColumn("v", F.col("value").cast("double"))
    falling = F.array_sort(F.collect_list(F.struct("rank", "v")))["v"]
    imp = imp.groupBy("model").agg(F.count(F.lit(1)).alias("n"), (F.abs(F.sum("v") - 1) < 0.001).alias("sums_to_one"),
                                   (F.sort_array(falling, asc=False) == falling).alias("falling"))
    cells = rows.where("section = 'confusion' AND name IN ('tp', 'fn')").groupBy("model").agg(F.sum(F.col("value").cast("long")).alias("failures"))
    return cells.join(imp, "model")


@query("R3_dataset_info")
def _(spark, d):
    info = publish.dataset_info(R(spark, d), LABEL, X.MODES)
    return rounded(info.select("total_registros", "total_fallas", "tasa_falla_pct", *[F.col("frecuencias_modo")[m].alias(m) for m in X.MODES]))


@query("R4_metrics_long")
def _(spark, d):
    return publish.metrics_long(records(spark, d), X.RULES, {"dataset": "readings"})


@query("R5_notebook_payload")
def _(spark, d):
    doc = publish.notebook_payload(records(spark, d))
    return doc.select("mejor_modelo", "hipotesis_verificada", "recall_minimo_hipotesis", F.inline(F.transform(
        F.map_entries("modelos"), lambda e: F.struct(e["key"].alias("model"), e["value"]["recall"].alias("recall"), e["value"]["f1"].alias("f1"), e["value"]["confusion_matrix"]["tp"].alias("tp")))))
