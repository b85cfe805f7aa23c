"""Published tables and documents, from the nested records of `evaluate_models`.

`records` has one row per model. Optional columns `feature_importance`, `coeficientes` and
`hiperparametros` are maps. Field names of the documents are fixed by their readers.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep import defaults as D
from upkeep.functions import scalars as S
from upkeep.operators.choose import best_by_f1, select_best
from upkeep.operators.profile import class_distribution, mode_frequency


def _best_name(records, min_recall):
    """The chosen model's name as a scalar; input order is the `ordinal` column if there is one."""
    rows = records.select(
        "model", "recall", "f1", "auc_roc", *([F.col("ordinal")] if "ordinal" in records.columns else [F.col("model").alias("ordinal")])
    )
    return select_best(rows, min_recall).agg(F.first("model")).scalar()


def metrics_table(records: DataFrame, min_recall: float = D.MIN_RECALL) -> DataFrame:
    """The flat 21-column row per model."""
    def side(name, field):
        return F.col("por_clase")[name][field]

    cm, h = "confusion_matrix", "hipotesis"
    per_class = [
        side(name, field).alias(f"{label}_{name}")
        for name in ("Normal", "Falla")
        for field, label in (("precision", "Precision"), ("recall", "Recall"), ("f1", "F1"))
    ]
    return records.withColumn("__best", _best_name(records, min_recall)).select(
        F.col("model").alias("Modelo"), F.col("accuracy").alias("Accuracy"), F.col("precision").alias("Precision"),
        F.col("recall").alias("Recall"), F.col("f1").alias("F1_Score"), F.col("auc_roc").alias("AUC_ROC"),
        F.col("cv_f1_mean").alias("CV_F1_Mean"), F.col("cv_f1_std").alias("CV_F1_Std"),
        *[F.col(f"{cm}.{c}").alias(c.upper()) for c in ("tp", "fp", "tn", "fn")],
        *per_class,
        F.col(f"{h}.recall_minimo").alias("Hipotesis_Recall"), F.col(f"{h}.verificada").alias("Hipotesis_Cumplida"),
        (F.col("model") == F.col("__best")).alias("Mejor_Modelo"),
    )


def dataset_info(df: DataFrame, label: str = D.TARGET, modes: list = None, name: str = None, doi: str = None) -> DataFrame:
    """One row: totals, failure rate at 2 digits, counts per mode; all computed from the data."""
    freq = mode_frequency(df, modes).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("mode", "n"))))).scalar()
    return class_distribution(df, label).select(
        F.lit(name).cast("string").alias("nombre"), F.lit(doi).cast("string").alias("doi"), F.col("total").alias("total_registros"),
        F.col("failures").alias("total_fallas"), F.round("failure_pct", 2).alias("tasa_falla_pct"),
        F.array(*[F.lit(m) for m in (modes or D.MODES)]).alias("modos_falla"), freq.alias("frecuencias_modo"),
    )


def rules_map(rules: list = None):
    """Risk rules as a map '<variable>_<unit>' -> '> 299.10'."""
    rules = rules or D.RISK_RULES
    entries = [x for v, d, t, u in rules for x in (F.lit(f"{v}_{u}"), F.lit(f"{d} {t:.2f}"))]
    return F.create_map(*entries)


def _meta(meta: dict = None):
    """Entries whose names do not start with an underscore, as a map of text."""
    pairs = [x for k, v in (meta or {}).items() if not k.startswith("_") for x in (F.lit(k), F.lit(str(v)))]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def _ordered(records):
    if "ordinal" in records.columns:
        return records
    return records.withColumn("ordinal", F.col("model"))


def dashboard_payload(
    records: DataFrame, info: DataFrame = None, rules: list = None, min_recall: float = D.MIN_RECALL, all_must_pass: bool = False,
    meta: dict = None,
) -> DataFrame:
    """One row with one nested document: comparison arrays, ROC arrays, ranked importance of the
    chosen model, confusion, per class, hypothesis and data set. One row per model goes in."""
    records = _ordered(records)
    best = _best_name(records, min_recall)
    imp = F.col("feature_importance") if "feature_importance" in records.columns else F.lit(None).cast("map<string,double>")
    per_model = F.struct(
        "ordinal", "model", "accuracy", "precision", "recall", "f1", "auc_roc", "cv_f1_mean", "cv_f1_std",
        "hipotesis", "confusion_matrix", "por_clase", "curva_roc", imp.alias("importance"),
    )
    in_order = F.array_sort(
        F.collect_list(per_model),
        lambda a, b: F.when(a["ordinal"] < b["ordinal"], -1).when(a["ordinal"] > b["ordinal"], 1).otherwise(0),
    )
    one = records.agg(in_order.alias("m")).select(
        "m", best.alias("best"), (info.agg(F.first(F.struct(*info.columns))).scalar() if info is not None else F.lit(None)).alias("dataset")
    )
    m = F.col("m")

    def keyed(value):
        return F.map_from_entries(F.transform(m, lambda r: F.struct(r["model"], value(r))))

    chosen = F.filter(m, lambda r: r["model"] == F.col("best"))[0]
    ranked = F.transform(
        F.reverse(F.array_sort(F.transform(F.map_entries(chosen["importance"]), lambda e: F.struct(e["value"].alias("importancia"), e["key"].alias("variable"))))),
        lambda e: F.struct(e["variable"].alias("variable"), e["importancia"].alias("importancia")),
    )
    verified = F.forall(m, lambda r: r["hipotesis"]["verificada"]) if all_must_pass else chosen["hipotesis"]["verificada"]
    fields = ["accuracy", "precision", "recall", "f1", "auc_roc"]
    return one.select(
        F.current_timestamp().alias("generado_en"), F.lit("1.0").alias("version"), _meta(meta).alias("meta"), "dataset", F.col("best").alias("mejor_modelo"),
        F.struct(
            F.lit(float(min_recall)).alias("recall_minimo"), verified.alias("verificada"), F.col("best").alias("mejor_modelo"),
            chosen["recall"].alias("mejor_recall"), rules_map(rules).alias("intervalos"),
        ).alias("hipotesis"),
        keyed(lambda r: F.struct(*[r[f].alias(f) for f in [*fields, "cv_f1_mean", "cv_f1_std", "hipotesis"]])).alias("modelos"),
        F.struct(
            m["model"].alias("nombres"),
            *[m[f].alias(f) for f in fields],
            F.transform(m, lambda r: F.coalesce(r["cv_f1_mean"], F.lit(0.0))).alias("cv_f1"),
        ).alias("comparacion"),
        keyed(lambda r: F.struct(r["curva_roc"]["fpr"].alias("fpr"), r["curva_roc"]["tpr"].alias("tpr"), r["auc_roc"].alias("auc_roc"))).alias("roc_curves"),
        F.coalesce(ranked, F.array().cast("array<struct<variable:string,importancia:double>>")).alias("feature_importance"),
        keyed(lambda r: r["confusion_matrix"]).alias("confusion_matrices"),
        keyed(lambda r: r["por_clase"]).alias("por_clase"),
    )


def notebook_payload(records: DataFrame, meta: dict = None, min_recall: float = D.MIN_RECALL) -> DataFrame:
    """The run record whose chosen model is the best F1, gate or no gate, and whose verdict asks every model to pass."""
    return run_record(records, meta, min_recall, all_must_pass=True, gated=False)


def run_record(records: DataFrame, meta: dict = None, min_recall: float = D.MIN_RECALL, all_must_pass: bool = False, gated: bool = True) -> DataFrame:
    """One row: meta, time, chosen model, its verdict (or that of all) and model -> record."""
    records = _ordered(records)
    best = _best_name(records, min_recall) if gated else best_by_f1(records.select("model", "f1", "ordinal")).agg(F.first("model")).scalar()
    drop = {"ordinal", "model"}
    body = F.struct(*[c for c in records.columns if c not in drop])
    one = records.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("model", body)), lambda a, b: F.when(a["model"] < b["model"], -1).when(a["model"] > b["model"], 1).otherwise(0))).alias("modelos"),
        F.bool_and("hipotesis.verificada").alias("__all"),
    ).withColumn("mejor_modelo", best)
    verified = F.col("__all") if all_must_pass else F.col("modelos")[F.col("mejor_modelo")]["hipotesis"]["verificada"]
    return one.select(
        _meta(meta).alias("meta"),
        F.current_timestamp().alias("generado_en"), "mejor_modelo", F.lit(float(min_recall)).alias("recall_minimo_hipotesis"),
        verified.alias("hipotesis_verificada"), "modelos",
    )


def metrics_long(records: DataFrame, rules: list = None, meta: dict = None, min_recall: float = D.MIN_RECALL) -> DataFrame:
    """The text report's content as (model, section, name, rank, value) rows, values as text.

    Section `run` has what holds for all models: `meta`, the chosen model, the minimum recall and the verdict.
    Importances are ranked from the largest, equal ones by name; `rank` is null elsewhere.
    """
    def t(c):
        return F.format_string("%.4f", F.col(c))

    rows = [
        *[("metrics", c, t(c)) for c in ("accuracy", "precision", "recall", "f1", "auc_roc", "cv_f1_mean", "cv_f1_std")],
        *[("confusion", c, F.col(f"confusion_matrix.{c}").cast("string")) for c in ("tp", "fn", "fp")],
        ("hypothesis", "recall_minimo", F.col("hipotesis.recall_minimo").cast("string")),
        ("hypothesis", "recall_obtenido", t("hipotesis.recall_obtenido")),
        ("hypothesis", "verdict", S.verdict("hipotesis.verificada")),
    ]
    entries = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(n).alias("name"), v.alias("value")) for s, n, v in rows])
    missing_cv = F.col("name").startswith("cv_") & (F.coalesce(F.col("__cv"), F.lit(0.0)) == 0)
    out = records.select("model", F.col("cv_f1_mean").alias("__cv"), F.inline(entries)).where(~missing_cv).drop("__cv")
    out = out.withColumn("rank", F.lit(None).cast("int"))
    if "feature_importance" in records.columns:
        pairs = F.transform(F.map_entries("feature_importance"), lambda e: F.struct((-e["value"]).alias("v"), e["key"].alias("name")))
        imp = records.select("model", F.posexplode(F.array_sort(pairs)).alias("i", "e"))
        out = out.unionByName(imp.select(
            "model", F.lit("importance").alias("section"), "e.name", F.format_string("%.4f", -F.col("e.v")).alias("value"), (F.col("i") + 1).cast("int").alias("rank")))
    run = run_record(records, meta, min_recall).select(F.inline(F.map_entries(F.map_concat("meta", F.create_map(
        F.lit("mejor_modelo"), "mejor_modelo", F.lit("recall_minimo"), F.col("recall_minimo_hipotesis").cast("string"),
        F.lit("hipotesis"), S.verdict("hipotesis_verificada"))))).alias("name", "value"))
    intervals = records.sparkSession.createDataFrame(
        [(f"{v}_{u}", f"{d} {x:.2f}") for v, d, x, u in (rules or D.RISK_RULES)], "name string, value string"
    )
    for section, rows in (("run", run), ("intervals", intervals)):
        out = out.unionByName(rows.select(
            F.lit(None).cast("string").alias("model"), F.lit(section).alias("section"), "name", "value", F.lit(None).cast("int").alias("rank")))
    return out
