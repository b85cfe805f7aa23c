"""DuckDB SQL for the registered queries, over the same tables, whole."""

from checks import fixture as X
from checks import parts as P
from checks import tree_sql
from checks.parts import AUC, CODED, FLAT, LONG, METRICS, READINGS, SCALED, SCORED, SIZES, SPLIT, with_
from upkeep import defaults as D

FE = X.FEATURES
O = {}
_IN = ", ".join(FE)


def r(expr, digits=6):
    return f"round({expr}, {digits}) + 0.0"


def cols(names, digits=6):
    return ", ".join(f"{r(n, digits)} AS {n}" for n in names)


def base(select, *more):
    return with_(READINGS, *more, select=select)


O["S1_read_readings"] = base(f'SELECT k, kind AS "Type", {_IN}, failure FROM readings')
O["S2_rename_columns"] = base(
    "SELECT failure AS falla, " + ", ".join(f"{r(f'avg({c})')} AS {role}" for role, c in X.ROLES.items()) + " FROM readings GROUP BY failure")
O["S3_require_columns"] = base("SELECT failure, count(*) AS n FROM readings GROUP BY failure")
O["S4_dataset_summary"] = base(
    f"SELECT count(*) AS total, CAST(sum(failure) AS BIGINT) AS failures, {r('sum(failure) / count(*) * 100')} AS failure_pct, "
    "count(*) FILTER (f1 <= 2) AS nulls FROM readings")
_types = {"k": "string", "kind": "string", **{f: "double" for f in FE}, **{m: "int" for m in X.MODES}, "failure": "int"}
O["S5_schema_profile"] = base(
    "SELECT (SELECT count(*) FROM readings) AS n_rows, CAST(13 AS INTEGER) AS n_columns, CAST(position AS INTEGER) AS position, "
    'v."column", dtype, nulls FROM (' + " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS dtype, (SELECT count(*) FROM readings WHERE {c} IS NULL) AS nulls"
        for i, (c, t) in enumerate(_types.items(), 1)) + ") v")
O["S6_preview"] = base(f"SELECT k, {_IN}, failure FROM readings ORDER BY k LIMIT 8")
_names = ",".join(CODED)
O["S7_write_read_processed"] = base(
    f"""SELECT failure, (SELECT max(n - n_test) FROM sizes) AS n, 'train' AS part, '{_names}' AS features FROM sizes
UNION ALL SELECT failure, n_test, 'test', '{_names}' FROM sizes""", SIZES)

O["S11_trim_json"] = "SELECT event_id, event_type AS kind, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events"
O["S11_trim_json_deep"] = O["S11_trim_json"]

O["F1_encode_category"] = base(
    "SELECT k, CAST(dense_rank() OVER (ORDER BY kind) - 1 AS INTEGER) AS code FROM readings")
O["F2_add_temp_diff"] = base(f"SELECT k, {r('f4 - f3')} AS temp_diff FROM readings")
O["F3_add_power_w"] = base(f"SELECT k, {r('f1 * f2 * (2 * pi() / 60)', 3)} AS power_w FROM readings")
O["F4_select_features"] = base(f"SELECT k, {_IN}, failure AS label FROM readings")
O["F4_class_counts"] = base("SELECT failure, count(*) AS n FROM readings GROUP BY failure")
O["F5_by_class"] = base(f"SELECT k, {_IN} FROM readings WHERE failure = 1")
O["F6_by_mode"] = base(" UNION ALL ".join(f"SELECT '{m}' AS mode, k, {r('f1')} AS f1 FROM readings WHERE {m} = 1" for m in X.MODES))
O["F7_failure_mode_index"] = base(
    "SELECT k, CASE " + " ".join(f"WHEN {m} = 1 THEN {i}" for i, m in reversed(list(enumerate(X.MODES, 1)))) + " ELSE 0 END AS mode_index FROM readings")
_flags = {v: f"{v} {d} CAST({t} AS DOUBLE)" for v, d, t, _ in X.RULES}
O["F8_flag_risk_zone"] = base(
    "SELECT k, " + ", ".join(f"{e} AS {v}_risk" for v, e in _flags.items()) + ", "
    + " + ".join(f"CAST({e} AS INTEGER)" for e in _flags.values()) + " AS risk_count FROM readings")
O["F8_risk_stream"] = "SELECT event_id, value > 20.0 AS value_risk, CAST(value > 20.0 AS INTEGER) AS risk_count FROM events"
O["F9_significance_stars"] = base(
    "SELECT k, CASE WHEN f3 < CAST(0.001 AS DOUBLE) THEN '***' WHEN f3 < CAST(0.01 AS DOUBLE) THEN '**' "
    "WHEN f3 < CAST(0.05 AS DOUBLE) THEN '*' ELSE 'n.s.' END AS stars FROM readings")
O["F10_corr_strength"] = base(
    "SELECT k, CASE WHEN abs((f1 - 25) / 25) > CAST(0.7 AS DOUBLE) THEN 'alta' ELSE 'moderada' END AS strength FROM readings "
    "WHERE abs((f1 - 25) / 25) > CAST(0.3 AS DOUBLE)")
O["F11_sign_tag"] = base("SELECT k, CASE WHEN f3 - CAST(0.05 AS DOUBLE) > 0 THEN '[+]' ELSE '[-]' END AS tag FROM readings")
O["F12_verdict"] = base("SELECT k, CASE WHEN failure = 0 THEN 'NO FALSADA' ELSE 'FALSADA' END AS verdict FROM readings")
O["F13_drop_meta_keys"] = base("SELECT k, 'k,x' || kind AS keys FROM readings")

_pct = "count(*) FILTER (failure = {c}) / count(*) * 100"
O["A1_class_distribution"] = base(
    f"SELECT count(*) AS total, count(*) FILTER (failure = 0) AS normal, count(*) FILTER (failure = 1) AS failures, "
    f"{r(_pct.format(c=0))} AS normal_pct, {r(_pct.format(c=1))} AS failure_pct, "
    f"{r('count(*) FILTER (failure = 0) / count(*) FILTER (failure = 1)')} AS imbalance FROM readings")
O["A2_mode_frequency"] = base(" UNION ALL ".join(
    f"SELECT '{m}' AS mode, CAST(sum({m}) AS BIGINT) AS n, {r(f'sum({m}) / count(*) * 100')} AS pct FROM readings" for m in X.MODES))


def q(p, v="value"):
    return f"quantile_cont({v}, {p})"


_quart = f"{r(q(.25))} AS q1, {r(q(.5))} AS median, {r(q(.75))} AS q3"
O["A3_class_stats"] = base(
    f"SELECT variable, failure, count(*) AS n, {r('avg(value)')} AS mean, {r('stddev_samp(value)')} AS std, {_quart} FROM long GROUP BY 1, 2", LONG)
_T = """mom AS (SELECT variable, count(*) FILTER (failure = 0) AS n0, count(*) FILTER (failure = 1) AS n1,
  avg(value) FILTER (failure = 0) AS mean0, avg(value) FILTER (failure = 1) AS mean1,
  var_samp(value) FILTER (failure = 0) AS var0, var_samp(value) FILTER (failure = 1) AS var1 FROM long GROUP BY variable),
tt AS (SELECT *, n0 + n1 - 2 AS df,
  (mean0 - mean1) / sqrt(((n0 - 1) * var0 + (n1 - 1) * var1) / (n0 + n1 - 2) * (1 / n0 + 1 / n1)) AS t FROM mom)"""
_side = ", ".join(
    f"{r(f'quantile_cont(value, {p}) FILTER (failure = {c})', 5)} AS {n}_{s}"
    for n, p in (("q1", .25), ("q3", .75)) for c, s in ((0, "normal"), (1, "failure")))
O["T1_t_test_by_class"] = base(
    f"SELECT variable, n0, n1, {cols(['mean0', 'mean1'], 5)}, {r('t', 5)} AS t, df FROM tt", LONG, _T)
_LENTZ = """start AS (SELECT variable, df / 2.0::DOUBLE AS a, 0.5::DOUBLE AS b, df / (df + t * t) AS x FROM tt),
side AS (SELECT variable, x > (a + 1) / (a + b + 2) AS flip, CASE WHEN x > (a + 1) / (a + b + 2) THEN b ELSE a END AS a,
  CASE WHEN x > (a + 1) / (a + b + 2) THEN a ELSE b END AS b, CASE WHEN x > (a + 1) / (a + b + 2) THEN 1 - x ELSE x END AS x FROM start),
cf AS (SELECT variable, flip, a, b, x, 1 AS m, 1::DOUBLE AS c, 1 / (1 - (a + b) * x / (a + 1)) AS d, 1 / (1 - (a + b) * x / (a + 1)) AS h FROM side
  UNION ALL SELECT variable, flip, a, b, x, m + 1, c2, d2, h * c1 * d1 * c2 * d2 FROM (
    SELECT *, 1 / (1 + odd * d1) AS d2, 1 + odd / c1 AS c2 FROM (
      SELECT *, 1 / (1 + even * d) AS d1, 1 + even / c AS c1 FROM (
        SELECT *, m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) AS even, -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)) AS odd
        FROM cf WHERE m < 300)))),
tail AS (SELECT variable, abs(CAST(flip AS INTEGER) - exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(x) + b * ln(1 - x)) / a * h) AS p FROM cf WHERE m = 300)"""
O["T1_p_values"] = "WITH RECURSIVE" + base(
    f"SELECT variable, {r('p', 5)} AS p, CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE 'n.s.' END AS stars FROM tail",
    LONG, _T, _LENTZ)[4:]
_STARS = "CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE 'n.s.' END AS stars"
O["A4_class_contrast"] = "WITH RECURSIVE" + base(
    f"SELECT tt.variable, {r('mean0', 5)} AS mean_normal, {r('mean1', 5)} AS mean_failure, {r('mean1 - mean0', 5)} AS delta, "
    f"s.* EXCLUDE (variable), {r('t', 5)} AS t, df, {r('p', 5)} AS p, {_STARS} FROM tt JOIN (SELECT variable, {_side} FROM long GROUP BY variable) s USING (variable) "
    "JOIN tail USING (variable)", LONG, _T, _LENTZ)[4:]
O["S9_write_stats_csv"] = O["A4_class_contrast"].replace(", 5) + 0.0", ", 6) + 0.0")
_range = f"{r('min(value + 0.0)')} AS min, {r('max(value + 0.0)')} AS max"
O["A5_describe_features"] = base(
    f'SELECT variable, count(*) AS "count", {r("avg(value)")} AS mean, {r("stddev_samp(value)")} AS std, {_range}, {_quart} FROM long GROUP BY 1'.replace(", 6)", ", 7)"), LONG)
_bymode = " UNION ALL ".join(f"SELECT '{m}' AS mode, variable, value FROM long WHERE {m} = 1" for m in X.MODES)
O["A6_mode_intervals"] = base(f"SELECT mode, variable, count(*) AS n, {_range}, {_quart} FROM ({_bymode}) GROUP BY 1, 2", LONG)
O["A7_failure_q1_zones"] = base(
    f"SELECT variable, CASE WHEN variable = 'f2' THEN '<' ELSE '>' END AS direction, {r(q(.25))} AS q1 FROM long WHERE failure = 1 GROUP BY 1", LONG)
_rules = "rules(variable, direction, threshold, unit) AS (VALUES " + ", ".join(
    f"('{v}', '{d}', CAST({t} AS DOUBLE), '{u}')" for v, d, t, u in X.RULES) + ")"
_valid = f"""checked AS (SELECT rules.*, q1, CASE WHEN direction = '>' THEN q1 >= threshold * (1 - CAST(0.05 AS DOUBLE))
  ELSE q1 <= threshold * (1 + CAST(0.05 AS DOUBLE)) END AS ok
  FROM rules JOIN (SELECT variable, round(quantile_cont(value, 0.25), 2) AS q1 FROM long WHERE failure = 1 GROUP BY 1) USING (variable))"""
O["A8_validate_intervals"] = base(
    f"SELECT variable, direction, {r('threshold')} AS threshold, unit, {r('q1')} AS q1, ok, CASE WHEN ok THEN 'OK' ELSE 'REVISAR' END AS status, "
    f"{r('abs(q1 - threshold) / threshold * 100')} AS margin_pct FROM checked", LONG, _rules, _valid)
O["A9_intervals_concordant"] = base("SELECT bool_and(ok) AS concordant FROM checked", LONG, _rules, _valid)
O["A10_rate_by_category"] = base(
    f"SELECT kind, CAST(sum(failure) AS BIGINT) AS failures, count(*) AS n, {r('sum(failure) / count(*) * 100')} AS rate_pct FROM readings GROUP BY kind")
O["A10_rate_by_source"] = (
    f"SELECT source, CAST(sum(toxic) AS BIGINT) AS failures, count(toxic) AS n, {r('sum(toxic) / count(toxic) * 100')} AS rate_pct "
    "FROM labels JOIN documents USING (doc_id) GROUP BY source")
O["A11_split_report"] = base(
    f"SELECT split, count(*) AS n, count(*) FILTER (failure = 0) AS normal, count(*) FILTER (failure = 1) AS failures, "
    f"{r('count(*) FILTER (failure = 1) / count(*) * 100')} AS failure_pct FROM split GROUP BY split", SIZES, SPLIT)
O["A12_balance_report"] = base(
    f"SELECT failure, before, {r('before / sum(before) OVER () * 100')} AS before_pct, after, {r('after / sum(after) OVER () * 100')} AS after_pct, "
    "after - before AS created FROM (SELECT failure, n - n_test AS before, (SELECT max(n - n_test) FROM sizes) AS after FROM sizes)", SIZES)


def _n(part, c):
    return f"(SELECT count(*) FROM split WHERE split = '{part}' AND failure = {c})"


O["A13_prep_summary"] = base(
    f"""SELECT (SELECT count(*) FROM readings) AS total, '{_names}' AS features, CAST(0.2 AS DOUBLE) AS test_size, 42 AS seed,
 {_n('train', 0)} + {_n('train', 1)} AS train, {_n('test', 0)} + {_n('test', 1)} AS test, {_n('train', 0)} AS train_normal,
 {_n('train', 1)} AS train_failures, {_n('test', 0)} AS test_normal, {_n('test', 1)} AS test_failures,
 {_n('train', 0)} AS bal_normal, {_n('train', 0)} AS bal_failures, {_n('train', 0)} - {_n('train', 1)} AS created""", SIZES, SPLIT)

O["C1_corr_with_target"] = base(
    f"SELECT variable, {r('corr(value, failure)')} AS r, {r('abs(corr(value, failure))')} AS abs_r FROM long GROUP BY variable", LONG)
O["C2_corr_with_target_signed"] = base(f"SELECT variable, {r('corr(value, failure)')} AS r FROM long GROUP BY variable", LONG)
_all = [*FE, "failure"]
O["C3_corr_matrix"] = base(" UNION ALL ".join(
    f"SELECT '{x}' AS x, '{y}' AS y, {'CAST(1 AS DOUBLE)' if x == y else r(f'max(c_{x}_{y})')} AS r FROM c" for x in _all for y in _all),
    "c AS (SELECT " + ", ".join(f"corr({x}, {y}) AS c_{x}_{y}" for x in _all for y in _all if x != y) + " FROM readings)").replace("AS DOUBLE) AS r FROM c", "AS DOUBLE) AS r")
O["C3_corr_matrix_wide"] = base(" UNION ALL ".join(
    f"SELECT '{x}' AS x, " + ", ".join(f"{'CAST(1 AS DOUBLE)' if x == y else r(f'c_{x}_{y}')} AS {y}" for y in FE) + " FROM c" for x in FE),
    "c AS (SELECT " + ", ".join(f"corr({x}, {y}) AS c_{x}_{y}" for x in FE for y in FE if x != y) + " FROM readings)")
_more = {**{f: f for f in FE}, "f6": "f1 * f2", "f7": "-f1"}
_pairs = [(x, y) for i, x in enumerate(_more) for y in list(_more)[i + 1:]]
O["C4_corr_pairs"] = base(
    f"SELECT x, y, {r('r')} AS r, CASE WHEN abs(r) > CAST(0.7 AS DOUBLE) THEN 'alta' ELSE 'moderada' END AS strength FROM ("
    + " UNION ALL ".join(f"SELECT '{x}' AS x, '{y}' AS y, corr({_more[x]}, {_more[y]}) AS r FROM readings" for x, y in _pairs)
    + ") WHERE abs(r) > CAST(0.3 AS DOUBLE)")
O["C5_top_corr"] = base(
    f"SELECT variable, {r('abs_r')} AS abs_r, 'f1' AS pair_x, 'f2' AS pair_y, (SELECT {r('corr(f1, f2)')} FROM readings) AS pair_r FROM ("
    "SELECT variable, abs(corr(value, failure)) AS abs_r FROM long GROUP BY variable) ORDER BY abs_r DESC LIMIT 1", LONG)


def hist(group, source, bins):
    keys = ", ".join(group)
    same = " AND ".join(f"g.{c} = c.{c}" for c in group)
    return f"""rng AS (SELECT {keys}, CASE WHEN min(value) = max(value) THEN min(value + 0.0) - 0.5 ELSE min(value + 0.0) END AS l,
  CASE WHEN min(value) = max(value) THEN max(value + 0.0) + 0.5 ELSE max(value + 0.0) END AS h, count(*) AS n, avg(value) AS mean FROM {source} GROUP BY {keys}),
first AS (SELECT *, (h - l) / {bins} AS step, least(CAST(floor((value - l) / (h - l) * {bins}) AS INTEGER), {bins - 1}) AS i FROM {source} JOIN rng USING ({keys})),
cnt AS (SELECT {keys}, CASE WHEN value < l + i * step THEN i - 1 WHEN value >= l + (i + 1) * step AND i <> {bins - 1} THEN i + 1 ELSE i END AS bin,
  count(*) AS n FROM first GROUP BY ALL),
hist AS (SELECT {', '.join('g.' + c for c in group)}, CAST(b.bin AS INTEGER) AS bin, {r(f'g.l + b.bin * ((g.h - g.l) / {bins})')} AS lo,
  {r(f'CASE WHEN b.bin = {bins - 1} THEN g.h ELSE g.l + (b.bin + 1) * ((g.h - g.l) / {bins}) END')} AS hi,
  coalesce(c.n, 0) AS "count", {r(f'coalesce(c.n, 0) / (g.n * ((g.h - g.l) / {bins}))')} AS density, {r('g.mean')} AS mean
  FROM rng g CROSS JOIN (SELECT unnest(range({bins})) AS bin) b LEFT JOIN cnt c ON {same} AND c.bin = b.bin)"""


O["H1_histogram_by_class"] = "WITH RECURSIVE" + base(
    "SELECT hist.*, CASE WHEN p < 0.001 THEN '(p<0.001 ***)' ELSE printf('(p=%.3f)', p) END AS p_label FROM hist JOIN tail USING (variable)",
    LONG, _T, _LENTZ, hist(["variable", "failure"], "long", 40))[4:]
O["H2_histogram_by_category"] = base(
    "SELECT * FROM hist", "f5s AS (SELECT kind, f5 AS value FROM readings WHERE failure = 1)", hist(["kind"], "f5s", 30))
O["H3_boxplot_stats"] = base(
    f"""SELECT variable, failure, count(*) AS n, {r('q1')} AS q1, {r('median')} AS median, {r('q3')} AS q3,
 {r('least(min(value) FILTER (value >= q1 - 1.5::DOUBLE * (q3 - q1)), q1)')} AS whisker_low,
 {r('greatest(max(value) FILTER (value <= q3 + 1.5::DOUBLE * (q3 - q1)), q3)')} AS whisker_high,
 count(*) FILTER (value < q1 - 1.5::DOUBLE * (q3 - q1) OR value > q3 + 1.5::DOUBLE * (q3 - q1)) AS outliers
 FROM long JOIN box USING (variable, failure) GROUP BY variable, failure, q1, median, q3""",
    LONG, f"box AS (SELECT variable, failure, {q(.25)} AS q1, {q(.5)} AS median, {q(.75)} AS q3 FROM long GROUP BY 1, 2)")


def grid(x, y, group, bins):
    def one(v):
        i = f"least(CAST(floor(({v} - {v}0) / ({v}1 - {v}0) * {bins}) AS INTEGER), {bins - 1})"
        s = f"(({v}1 - {v}0) / {bins})"
        return (f"CAST(CASE WHEN {v} < {v}0 + {i} * {s} THEN {i} - 1 WHEN {v} >= {v}0 + ({i} + 1) * {s} AND {i} <> {bins - 1} THEN {i} + 1 ELSE {i} END AS INTEGER)")

    ext = ", ".join(f"min({v} + 0.0) AS {v}0, max({v} + 0.0) AS {v}1" for v in (x, y))
    return (f"SELECT {group[1]} AS {group[0]}, {one(x)} AS bin_x, {one(y)} AS bin_y, count(*) AS n, {r(f'avg({x})')} AS mean_x, {r(f'avg({y})')} AS mean_y "
            f"FROM readings, (SELECT {ext} FROM readings) GROUP BY 1, 2, 3")


O["H4_scatter_bins"] = base(grid("f2", "f1", ("failure", "failure"), 50))
_idx = "CASE " + " ".join(f"WHEN {m} = 1 THEN {i}" for i, m in reversed(list(enumerate(X.MODES, 1)))) + " ELSE 0 END"
O["H4_scatter_by_mode"] = base(grid("f5", "f4", ("modo_idx", _idx), 20))
O["H4_scatter_sample"] = base(
    f"SELECT k, f1, f2, failure FROM readings WHERE ('0x' || substr(md5('42|' || k), 1, 12))::BIGINT / 281474976710656 < CAST(0.05 AS DOUBLE)")

EVAL = (SCORED, METRICS)
FULL = (SCORED, METRICS, AUC, FLAT)
_five = ["accuracy", "precision", "recall", "f1", "auc_roc"]
O["H5_metric_table_long"] = base(" UNION ALL ".join(
    [f"SELECT model, '{m}' AS metric, {r(m)} AS value FROM flat" for m in _five]
    + [f"SELECT model, '{m}', CAST(0 AS DOUBLE) FROM flat" for m in ("cv_f1_mean", "cv_f1_std")]), *FULL)
O["H6_importance_ranked"] = base(
    f"""SELECT variable, {r('importance')} AS importance, CAST(row_number() OVER (ORDER BY importance DESC, variable) AS INTEGER) AS rank,
 importance = max(importance) OVER () AS is_max FROM (SELECT variable, abs(corr(value, failure)) AS importance FROM long GROUP BY variable)""", LONG)
O["H7_best_per_metric"] = base(
    f"SELECT model, metric, {r('value')} AS value, value = max(value) OVER (PARTITION BY metric) AS is_best FROM ("
    + " UNION ALL ".join(f"SELECT model, '{m}' AS metric, {m} AS value FROM flat" for m in _five) + ")", *FULL)
_best = "(SELECT * FROM flat ORDER BY round(recall, 4) >= 0.8 DESC, round(f1, 4) DESC, round(auc_roc, 4) DESC, ordinal LIMIT 1)"
O["H8_kpis"] = base(
    f"SELECT (SELECT count(*) FROM readings) AS total, (SELECT {r('sum(failure) / count(*) * 100')} FROM readings) AS failure_pct, "
    f"model AS best_model, {r('recall')} AS best_recall, CAST(0.8 AS DOUBLE) AS target_recall FROM {_best}", *FULL)

O["P1_stratified_split"] = base("SELECT k, failure, split FROM split", SIZES, SPLIT)
O["P2_apply_scaler"] = base(f"SELECT k, {', '.join(CODED)} FROM scaled WHERE split = 'test'", SIZES, SPLIT, SCALED)
O["P3_scaler_params"] = base(" UNION ALL ".join(
    f"SELECT '{f}' AS variable, {r(f'mu_{f}')} AS mean, {r(f'sd_{f}')} AS scale FROM params" for f in CODED), SIZES, SPLIT, SCALED)
_d2 = " + ".join(f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in CODED)
NEAR = f"""minor AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || k), k) - 1 AS row FROM scaled WHERE split = 'train' AND failure = 1),
near AS (SELECT * FROM (SELECT a.k, b.k AS neighbour, CAST(row_number() OVER (PARTITION BY a.k ORDER BY {_d2}, b.k) - 1 AS INTEGER) AS place
  FROM minor a JOIN minor b ON a.k <> b.k) WHERE place < 5)"""
O["P4_nearest_neighbours"] = base("SELECT k, place, neighbour FROM near", SIZES, SPLIT, SCALED, NEAR)
_between = ", ".join(f"a.{f} + d.u * (b.{f} - a.{f}) AS {f}" for f in CODED)
O["P4_smote"] = base(
    f"""SELECT k, failure, {', '.join(CODED)}, false AS synthetic, NULL AS base_key FROM scaled WHERE split = 'train'
UNION ALL SELECT 'synthetic-1-' || d.i, 1, {_between}, true, a.k
FROM draws d JOIN minor a ON a.row = d.pair // 5 JOIN near n ON n.k = a.k AND n.place = d.pair % 5 JOIN minor b ON b.k = n.neighbour""",
    SIZES, SPLIT, SCALED, NEAR,
    """counts AS (SELECT count(*) FILTER (failure = 0) AS n0, count(*) FILTER (failure = 1) AS n1 FROM scaled WHERE split = 'train'),
draws AS (SELECT i, ('0x' || substr(h, 1, 12))::BIGINT % (5 * (SELECT n1 FROM counts)) AS pair,
  ('0x' || substr(h, 13, 12))::BIGINT / 281474976710656 AS u FROM (
  SELECT i, md5('42|synthetic|1|' || i) AS h FROM (SELECT unnest(range((SELECT n0 - n1 FROM counts))) AS i)))""")
O["P5_class_weights"] = base(
    f"SELECT failure, n - n_test AS n, {r('sum(n - n_test) OVER () / (count(*) OVER () * (n - n_test))')} AS weight FROM sizes", SIZES)
O["P6_stratified_folds"] = base(
    "SELECT k, failure, CAST(ntile(5) OVER (PARTITION BY failure ORDER BY md5('42|' || k), k) - 1 AS INTEGER) AS fold FROM readings")

O["V1_confusion"] = base("SELECT *, concat_ws(',', tn, fp, fn, tp) AS matrix FROM cells", *EVAL)
O["V2_binary_metrics"] = base(f"SELECT model, tn, fp, fn, tp, {cols(_five[:4])} FROM metrics", *EVAL)
O["V3_roc_auc"] = base(f"SELECT model, {r('auc_roc')} AS auc_roc FROM auc", SCORED, AUC)
_curve = f"""SELECT model, {r('probability')} AS threshold, {r('fp / n')} AS fpr, {r('tp / p')} AS tpr FROM (
  SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n,
    lag(pos) OVER w AS before, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg
  FROM byscore WINDOW w AS (PARTITION BY model ORDER BY probability DESC))
WHERE before IS NULL OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL SELECT DISTINCT model, NULL::DOUBLE, 0::DOUBLE, 0::DOUBLE FROM scored"""
O["V4_roc_curve"] = base(_curve, SCORED, AUC)


def side(name, hit, wrong, missed):
    return (f"SELECT model, '{name}' AS class, {r(f'coalesce({hit} / nullif({hit} + {wrong}, 0), 0)')} AS precision, "
            f"{r(f'coalesce({hit} / nullif({hit} + {missed}, 0), 0)')} AS recall, "
            f"{r(f'coalesce(2 * {hit} / nullif(2 * {hit} + {wrong} + {missed}, 0), 0)')} AS f1, {hit} + {missed} AS support FROM cells")


O["V5_per_class_report"] = base(side("Normal", "tn", "fn", "fp") + " UNION ALL " + side("Falla", "tp", "fp", "fn"), *EVAL)
_foldf1 = """folds AS (SELECT k, CAST(ntile(5) OVER (PARTITION BY failure ORDER BY md5('42|' || k), k) - 1 AS INTEGER) AS fold FROM readings),
foldf1 AS (SELECT model, fold, 2 * tp / (2 * tp + fp + fn) AS f1 FROM (SELECT model, fold,
  count(*) FILTER (failure = 0 AND prediction = 1) AS fp, count(*) FILTER (failure = 1 AND prediction = 0) AS fn,
  count(*) FILTER (failure = 1 AND prediction = 1) AS tp FROM scored JOIN folds USING (k) GROUP BY 1, 2))"""
O["V6_fold_f1"] = base(f"SELECT model, fold, {r('f1')} AS f1 FROM foldf1", SCORED, _foldf1)
O["V6_cv_summary"] = base(
    f"SELECT model, {r('avg(f1)')} AS cv_f1_mean, {r('stddev_pop(f1)')} AS cv_f1_std FROM foldf1 GROUP BY model", SCORED, _foldf1)
O["V7_hypothesis_check"] = base(
    f"SELECT model, CAST(0.8 AS DOUBLE) AS min_recall, {r('recall')} AS recall, recall >= 0.8 AS verified, "
    "CASE WHEN recall >= 0.8 THEN 'NO FALSADA' ELSE 'FALSADA' END AS verdict FROM metrics", *EVAL)
O["V8_all_models_pass"] = base("SELECT bool_and(recall >= 0.8) AS all_pass FROM metrics", *EVAL)
O["V9_evaluate_models"] = base(
    f"SELECT model, {cols(_five, 4)}, tn, fp, fn, tp, {r('tn / (tn + fp)', 4)} AS recall_normal, tp + fn AS support_failure, recall >= 0.8 AS verified FROM flat", *FULL)
O["V10_merge_previous_metrics"] = base(
    f"SELECT model, {r('f1')} AS f1, CASE WHEN model = 'rule_a' THEN {r('f1')} END AS cv_f1_mean, "
    f"CASE WHEN model <> 'rule_c' THEN {r('f1 / 10')} END AS cv_f1_std FROM flat", *FULL)

O["Q1_select_best"] = base(f"SELECT model, {cols(['recall', 'f1', 'auc_roc'])} FROM {_best}", *FULL)
O["Q2_best_by_f1"] = base(f"SELECT model, {r('f1')} AS f1 FROM flat ORDER BY round(f1, 4) DESC, ordinal LIMIT 1", *FULL)
O["Q2_best_by_auc"] = base(f"SELECT model, {r('auc_roc')} AS auc_roc FROM flat ORDER BY round(auc_roc, 4) DESC, ordinal LIMIT 1", *FULL)
O["Q3_ranked_comparison"] = base(
    f"SELECT ordinal, model, {cols(_five)}, 'N/A' AS cv_f1, model = (SELECT model FROM {_best}) AS is_best, "
    "CASE WHEN recall >= 0.8 THEN 'NO FALSADA' ELSE 'FALSADA' END AS verdict FROM flat", *FULL)
O["Q4_top_k"] = base(
    f"SELECT variable, {r('r')} AS r, {r('abs(r)')} AS abs_r FROM (SELECT variable, corr(value, failure) AS r FROM long GROUP BY variable) "
    "ORDER BY abs(r) DESC, variable LIMIT 3", LONG)


def klass(hit, wrong, missed, name):
    return (f"{r(f'coalesce({hit} / nullif({hit} + {wrong}, 0), 0)', 4)} AS \"Precision_{name}\", {r(f'coalesce({hit} / nullif({hit} + {missed}, 0), 0)', 4)} AS \"Recall_{name}\", "
            f"{r(f'coalesce(2 * {hit} / nullif(2 * {hit} + {wrong} + {missed}, 0), 0)', 4)} AS \"F1_{name}\"")


O["R1_metrics_table"] = base(
    f'SELECT model AS "Modelo", {r("accuracy", 4)} AS "Accuracy", {r("precision", 4)} AS "Precision", {r("recall", 4)} AS "Recall", {r("f1", 4)} AS "F1_Score", '
    f'{r("auc_roc", 4)} AS "AUC_ROC", NULL::DOUBLE AS "CV_F1_Mean", NULL::DOUBLE AS "CV_F1_Std", tp AS "TP", fp AS "FP", tn AS "TN", fn AS "FN", '
    f'{klass("tn", "fn", "fp", "Normal")}, {klass("tp", "fp", "fn", "Falla")}, CAST(0.8 AS DOUBLE) AS "Hipotesis_Recall", recall >= 0.8 AS "Hipotesis_Cumplida", '
    f'model = (SELECT model FROM {_best}) AS "Mejor_Modelo" FROM flat', *FULL)
O["R2_dashboard_payload"] = base(
    f"SELECT model AS best, recall >= 0.8 AS verified, {r('recall', 4)} AS recall, 'rule_a,rule_b,rule_c' AS names, (SELECT count(*) FROM readings) AS total, "
    "(SELECT string_agg(printf('%.4f', round(f1, 4)), ',' ORDER BY ordinal) FROM flat) AS f1s, (SELECT fn FROM flat WHERE model = 'rule_b') AS rule_b_fn, "
    f"(SELECT CAST(count(*) AS INTEGER) FROM (SELECT DISTINCT round(fpr, 4), round(tpr, 4) FROM ({_curve}) WHERE model = 'rule_c')) AS rule_c_points, "
    f"'< 3000.00' AS f2_rule, '{{\"dataset\":\"readings\"}}' AS meta, '10.1/readings' AS doi FROM {_best}", *FULL)
O["R3_dataset_info"] = base(
    f"SELECT count(*) AS total_registros, CAST(sum(failure) AS BIGINT) AS total_fallas, {r('sum(failure) / count(*) * 100', 2)} AS tasa_falla_pct, "
    + ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in X.MODES) + " FROM readings")
_text = " UNION ALL ".join(
    [f"SELECT model, 'metrics' AS section, '{m}' AS name, printf('%.4f', round({m}, 4)) AS value FROM flat" for m in _five]
    + [f"SELECT model, 'confusion', '{c}', CAST({c} AS VARCHAR) FROM flat" for c in ("tp", "fn", "fp")]
    + ["SELECT model, 'hypothesis', 'recall_minimo', '0.8' FROM flat", "SELECT model, 'hypothesis', 'recall_obtenido', printf('%.4f', round(recall, 4)) FROM flat",
       "SELECT NULL, 'run', 'dataset', 'readings'", "SELECT NULL, 'run', 'recall_minimo', '0.8'", f"SELECT NULL, 'run', 'mejor_modelo', model FROM {_best}",
       f"SELECT NULL, 'run', 'hipotesis', CASE WHEN recall >= 0.8 THEN 'NO FALSADA' ELSE 'FALSADA' END FROM {_best}"]
    + ["SELECT model, 'hypothesis', 'verdict', CASE WHEN recall >= 0.8 THEN 'NO FALSADA' ELSE 'FALSADA' END FROM flat"]
    + [f"SELECT NULL, 'intervals', '{v}_{u}', '{d} {t:.2f}'" for v, d, t, u in X.RULES])
O["R4_metrics_long"] = base(f"SELECT *, CAST(NULL AS INTEGER) AS rank FROM ({_text})", *FULL)
O["R5_notebook_payload"] = base(
    f"SELECT (SELECT model FROM flat ORDER BY round(f1, 4) DESC, ordinal LIMIT 1) AS mejor_modelo, (SELECT bool_and(recall >= 0.8) FROM flat) AS hipotesis_verificada, "
    f"CAST(0.8 AS DOUBLE) AS recall_minimo_hipotesis, model, {r('recall', 4)} AS recall, {r('f1', 4)} AS f1, tp FROM flat", *FULL)
O["S10_metrics_json"] = base(
    f"SELECT model, (SELECT model FROM {_best}) AS mejor_modelo, (SELECT recall >= 0.8 FROM {_best}) AS hipotesis_verificada, {r('recall', 4)} AS recall, tp, fp FROM flat", *FULL)

# properties that hold for any right fit, over all rows
O["S8_saved_scaler"] = base(
    "SELECT k, " + ", ".join(f"{r(f'({f} - mu_{f}) / sd_{f}', 5)} AS {f}" for f in CODED) + " FROM split, params WHERE split = 'test'", SIZES, SPLIT, SCALED)
O["M3_gradient"] = " UNION ALL ".join(f"SELECT '{f}' AS variable, CAST(0 AS DOUBLE) AS slope" for f in CODED)
O["M5_importance_total"] = f"SELECT CAST({len(CODED)} AS BIGINT) AS n, CAST(1 AS DOUBLE) AS total"
O["X1_stream_equals_batch"] = base(
    "SELECT count(*) AS n, CAST(0 AS BIGINT) AS differing FROM split WHERE split = 'test'", SIZES, SPLIT)
O["M1_best_split"] = base(
    f"SELECT variable, n, failures, lo, hi, {r('share1 / (share0 + share1)')} AS probability, CAST(share1 > share0 AS INTEGER) AS prediction FROM ("
    f"SELECT variable, count(*) AS n, count(*) FILTER (failure = 1) AS failures, {r('min(value)')} AS lo, {r('max(value)')} AS hi, "
    "count(*) FILTER (failure = 1) / any_value(tp) AS share1, count(*) FILTER (failure = 0) / any_value(tn - tp) AS share0 "
    "FROM long JOIN best USING (variable) GROUP BY variable, value <= cut)",
    LONG,
    """cand AS (SELECT variable, value, count(*) AS n, sum(failure) AS p FROM long WHERE variable <> 'f2' GROUP BY 1, 2),
run AS (SELECT *, sum(n) OVER w AS ln, sum(p) OVER w AS lp, sum(n) OVER (PARTITION BY variable) AS tn, sum(p) OVER (PARTITION BY variable) AS tp
  FROM cand WINDOW w AS (PARTITION BY variable ORDER BY value)),
share AS (SELECT *, lp / tp AS s1, (ln - lp) / (tn - tp) AS s0 FROM run WHERE ln < tn),
best AS (SELECT variable, value AS cut, tp, tn FROM share ORDER BY s1 * s0 / (s1 + s0) + (1 - s1) * (1 - s0) / (2 - s1 - s0), variable, value LIMIT 1)""")
O["M4_leaves_reached"] = base("SELECT 2 * max(n - n_test) AS n, 0 AS empty_leaves, 1 AS more_leaves, true AS within_depth FROM sizes", SIZES)
O["M7_converged"] = "SELECT 1000 AS max_iterations, true AS converged"
O["M9_set_params"] = "SELECT * FROM (VALUES ('maxDepth', '6'), ('impurity', 'gini'), ('seed', '42'), ('weightCol', 'weight')) v(param, value)"
O["X1_prediction_rule"] = base(
    "SELECT model, CAST(sum(n_test) AS BIGINT) AS n, max(n_test) FILTER (failure = 1) AS failures, CAST(0 AS BIGINT) AS broken "
    "FROM sizes, (VALUES ('tree'), ('forest'), ('logistic')) v(model) GROUP BY model", SIZES)
O["R4_trained_report"] = base(
    f"SELECT model, (SELECT n_test FROM sizes WHERE failure = 1) AS failures, CAST(n AS BIGINT) AS n, sums_to_one, falling FROM (VALUES "
    f"('{D.TREE}', {len(CODED)}, true, true), ('{D.FOREST}', {len(CODED)}, true, true)) v(model, n, sums_to_one, falling)", SIZES)
O["V9_roc_all_points"] = base(f"SELECT model, CAST(count(*) AS INTEGER) AS points, CAST(count(*) AS INTEGER) AS points_tpr FROM ({_curve}) GROUP BY model", SCORED, AUC)
O.update(tree_sql.SQL)
O["M9_records_of_training"] = with_(
    *tree_sql.GROWN, SCORED, _foldf1,
    select=f"SELECT 'forest' AS model, (SELECT string_agg(variable || '=' || printf('%.4f', round(importance, 4)), ',' ORDER BY variable) FROM ({tree_sql.IMPORTANCE})) AS shares, "
           f"(SELECT oob_accuracy FROM ({tree_sql.OOB})) AS oob_score, '{P.SMALL_TREES}' AS trees, round(avg(f1), 4) AS cv_f1_mean, round(stddev_pop(f1), 4) AS cv_f1_std FROM foldf1 WHERE model = 'rule_a'")
