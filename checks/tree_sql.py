"""DuckDB SQL that grows the small bagged forest of `parts.small_forest` from the readings: three trees of two levels."""

from checks.parts import CODED, LABEL, PAIR, READINGS, SCALED, SHORT, SIZES, SMALL_TREES, SPLIT, with_
from upkeep.operators.trees import POISSON

_U = "CAST(CAST('0x' || substr(md5(concat_ws('|', '42', 'bag', t, k)), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656"
_BAG = " + ".join(f"CAST(u >= CAST({s!r} AS DOUBLE) AS INTEGER)" for s in POISSON)
_COLUMNS = ", ".join(SHORT)
_DOUBLES = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in SHORT)
_TREES = f"(SELECT CAST(unnest(range({SMALL_TREES})) AS INTEGER) AS t)"
_ORDER = "CASE variable " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(SHORT)) + " END"
_READ = "CASE variable " + " ".join(f"WHEN '{c}' THEN {c}" for c in SHORT) + " END"


def _gini(a, b):
    return f"(1 - ({a} * {a} + {b} * {b}) / (({a} + {b}) * ({a} + {b})))"


def _level(i):
    """Cells of each node's readings, its best split, and the rows one level further down."""
    return f"""cells{i} AS (SELECT tree, path, variable, value, coalesce(sum(w) FILTER (y = 0), 0) AS c0, coalesce(sum(w) FILTER (y = 1), 0) AS c1
  FROM (SELECT * FROM at{i} UNPIVOT (value FOR variable IN ({_COLUMNS}))) GROUP BY ALL),
run{i} AS (SELECT *, sum(c0) OVER v AS l0, sum(c1) OVER v AS l1, sum(c0) OVER all_ AS t0, sum(c1) OVER all_ AS t1, row_number() OVER (PARTITION BY tree, path, variable ORDER BY value DESC) AS back
  FROM cells{i} WINDOW all_ AS (PARTITION BY tree, path, variable), v AS (PARTITION BY tree, path, variable ORDER BY value)),
gains{i} AS (SELECT *, {_gini('t0', 't1')} - (l0 + l1) / (t0 + t1) * {_gini('l0', 'l1')} - (t0 + t1 - l0 - l1) / (t0 + t1) * {_gini('(t0 - l0)', '(t1 - l1)')} AS gain FROM run{i} WHERE back > 1),
split{i} AS MATERIALIZED (SELECT tree, path, variable, (value + next) / 2 AS threshold, gain * (t0 + t1) AS gain FROM (
  SELECT *, row_number() OVER (PARTITION BY tree, path ORDER BY gain DESC, {_ORDER}, value) AS place FROM gains{i}) JOIN vals USING (tree, variable, value) WHERE place = 1 AND gain > 1e-12),
at{i + 1} AS MATERIALIZED (SELECT b.* REPLACE (path || CASE WHEN {_READ} <= threshold THEN 'L' ELSE 'R' END AS path) FROM at{i} b JOIN split{i} USING (tree, path))"""


_NODES = " UNION ALL ".join(f"SELECT tree, path, coalesce(sum(w) FILTER (y = 0), 0) AS c0, coalesce(sum(w) FILTER (y = 1), 0) AS c1 FROM at{i} GROUP BY ALL" for i in range(3))
GROWN = (READINGS, SIZES, SPLIT, f"""learn AS (SELECT k, {LABEL} AS y, {_DOUBLES} FROM split WHERE split = 'train'),
classes AS (SELECT y, sum(count(*)) OVER () / (2 * CAST(count(*) AS DOUBLE)) AS class_weight FROM learn GROUP BY y),
drawn AS MATERIALIZED (SELECT *, {_BAG} AS bag FROM (SELECT t AS tree, *, {_U} AS u FROM learn, {_TREES})),
at0 AS MATERIALIZED (SELECT tree, '' AS path, y, class_weight * bag AS w, {_COLUMNS} FROM drawn JOIN classes USING (y) WHERE bag > 0),
vals AS (SELECT tree, variable, value, lead(value) OVER (PARTITION BY tree, variable ORDER BY value) AS next FROM (SELECT DISTINCT tree, variable, value FROM (SELECT * FROM at0 UNPIVOT (value FOR variable IN ({_COLUMNS})))))""",
         _level(0), _level(1), f"""every AS MATERIALIZED ({_NODES}),
-- a split whose leaves say the same is taken back
kept1 AS MATERIALIZED (SELECT s.* FROM split1 s JOIN every l ON l.tree = s.tree AND l.path = s.path || 'L' JOIN every r ON r.tree = s.tree AND r.path = s.path || 'R' WHERE (l.c1 > l.c0) <> (r.c1 > r.c0)),
kept0 AS MATERIALIZED (SELECT s.* FROM split0 s JOIN every l ON l.tree = s.tree AND l.path = 'L' JOIN every r ON r.tree = s.tree AND r.path = 'R'
  WHERE (l.c1 > l.c0) <> (r.c1 > r.c0) OR EXISTS (SELECT 1 FROM kept1 k WHERE k.tree = s.tree)),
kept AS (SELECT * FROM kept0 UNION ALL SELECT * FROM kept1),
nodes AS MATERIALIZED (SELECT e.*, variable, threshold, c1 / (c0 + c1) AS p FROM every e LEFT JOIN kept USING (tree, path)
  WHERE path = '' OR EXISTS (SELECT 1 FROM kept u WHERE u.tree = e.tree AND u.path = left(e.path, len(e.path) - 1)))""")


def _down(source):
    """The leaf of each (tree, k, readings) of `source`."""
    step = lambda of, n: f"SELECT b.* REPLACE (b.path || CASE WHEN variable IS NULL THEN '' WHEN {_READ} <= threshold THEN 'L' ELSE 'R' END AS path) FROM ({of}) b LEFT JOIN kept{n} USING (tree, path)"
    return f"SELECT d.*, p FROM ({step(step(f'SELECT *, {chr(39) * 2} AS path FROM ({source})', 0), 1)}) d JOIN nodes USING (tree, path)"


IMPORTANCE = ("SELECT variable, coalesce(sum(share) / (SELECT count(DISTINCT tree) FROM kept), 0) AS importance FROM "
              f"(SELECT unnest({SHORT}) AS variable) LEFT JOIN (SELECT variable, gain / sum(gain) OVER (PARTITION BY tree) AS share FROM kept) USING (variable) GROUP BY variable")
_OUT = f"({_down(f'SELECT tree, k, y, {_COLUMNS} FROM drawn WHERE bag = 0')})"
OOB = f"SELECT {SMALL_TREES} AS trees, count(*) AS rows, round(avg(CAST((p > 0.5) = (y = 1) AS DOUBLE)), 6) AS oob_accuracy FROM (SELECT k, y, avg(p) AS p FROM {_OUT} GROUP BY k, y)"
SQL = {
    "M2_bagged_trees": with_(*GROWN, select="SELECT tree, path, variable, round(threshold, 6) AS threshold, round(c0, 3) AS c0, round(c1, 3) AS c1, round(p, 6) AS p FROM nodes"),
    "M5_importance_from_data": with_(*GROWN, select=f"SELECT CAST(row_number() OVER (ORDER BY importance DESC, variable) AS INTEGER) AS rank, variable, round(importance, 6) AS importance FROM ({IMPORTANCE})"),
    "M8_out_of_bag": with_(*GROWN, select=f"SELECT k, y AS label, count(*) AS trees, round(avg(p), 6) AS probability FROM {_OUT} GROUP BY k, y"),
    "M8_oob_of_forest": with_(*GROWN, select=OOB),
    "X1_table_scores": with_(*GROWN, select=f"SELECT k, CAST(avg(p) > 0.5 AS INTEGER) AS prediction, round(avg(p), 6) AS probability FROM ({_down(f'SELECT t AS tree, k, {_DOUBLES} FROM split, {_TREES} WHERE split = {chr(39)}test{chr(39)}')}) GROUP BY k"),
    "X1_table_equals_model": with_(READINGS, SIZES, select="SELECT model, CAST(sum(n_test) AS BIGINT) AS n, CAST(0 AS BIGINT) AS differing FROM sizes, (VALUES ('tree'), ('forest')) v(model) GROUP BY model"),
}


def _newton(steps=9):
    """Logistic regression of two scaled features by Newton's method, unrolled; the penalty is 1/2 of each squared coefficient."""
    out = [f"pairs AS MATERIALIZED (SELECT CAST({LABEL} AS DOUBLE) AS y, {PAIR[0]} AS x1, {PAIR[1]} AS x2 FROM scaled WHERE split = 'train')",
           "b0 AS (SELECT CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS u, CAST(0 AS DOUBLE) AS v)"]
    for i in range(steps):
        out.append(f"""s{i} AS (SELECT a, u, v, sum(p - y) AS g0, sum((p - y) * x1) + u AS g1, sum((p - y) * x2) + v AS g2, sum(w) AS h00, sum(w * x1) AS h01, sum(w * x2) AS h02,
  sum(w * x1 * x1) + 1 AS h11, sum(w * x1 * x2) AS h12, sum(w * x2 * x2) + 1 AS h22 FROM (SELECT *, p * (1 - p) AS w FROM (SELECT *, 1 / (1 + exp(-(a + u * x1 + v * x2))) AS p FROM pairs, b{i})) GROUP BY a, u, v)""")
        out.append(f"""d{i} AS (SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS det FROM s{i}),
b{i + 1} AS (SELECT a - (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / det AS a,
  u - (h00 * (g1 * h22 - g2 * h12) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / det AS u,
  v - (h00 * (h11 * g2 - h12 * g1) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / det AS v FROM d{i})""")
    return out


SQL["M6_coefficients_of_two"] = with_(
    READINGS, SIZES, SPLIT, SCALED, *_newton(),
    select=f"SELECT CAST(row_number() OVER (ORDER BY abs(b) DESC) AS INTEGER) AS rank, variable, round(b, 3) AS coefficient, CASE WHEN b >= 0 THEN '[+]' ELSE '[-]' END AS sign, round(a, 3) AS intercept "
           f"FROM (SELECT '{PAIR[0]}' AS variable, u AS b, a FROM b9 UNION ALL SELECT '{PAIR[1]}', v, a FROM b9)")
SQL["M6_newton_step"] = " UNION ALL ".join(f"SELECT '{f}' AS variable, CAST(0 AS DOUBLE) AS step" for f in [*CODED, "intercept"])
