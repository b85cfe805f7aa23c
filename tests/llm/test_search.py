"""Exact searches against brute force: inner products over the impact-ordered index, and ranked lexical search."""

import math
import re
import string
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from upkeep.llm import impacts, lexical, queries

DIR = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def top_by_hand(rows, asks, k=5):
    """rows: (key, codes) in order; the best k of every other row for each row of `asks`."""
    out = []
    for q in asks:
        scores = sorted((-int(np.dot(rows[q][1], v)), key is None, key, i) for i, (key, v) in enumerate(rows) if i != q)
        out += [(rows[q][0], n, key, -s) for n, (s, _, key, _) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def test_query_of_vectors_against_brute_force(spark):
    got = queries.op12_topk_search(spark, DIR).collect()
    table = spark.read.parquet(f"{DIR}/embeddings.parquet").orderBy("vec_id").collect()
    rows = [(r["vec_id"], np.floor(256 * np.array(r["embedding"], np.float64)).astype(np.int64)) for r in table]
    want = top_by_hand(rows, [i for i, r in enumerate(rows) if r[0] % 50 == 0])
    assert sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got), key=str) == want and len(want) > 5


@pytest.mark.parametrize("shape", ["normal", "copies", "sparse", "skew"])
def test_block_search_is_exact(shape):
    rng = np.random.default_rng(len(shape))
    v = rng.integers(-150, 150, (700, 16))
    if shape == "copies":
        v[200:600] = v[0]
    if shape == "sparse":
        v[rng.random(v.shape) < 0.9] = 0
    if shape == "skew":
        v[:, 0] *= 1000
    order = np.argsort(v, axis=0, kind="stable").T
    value = np.take_along_axis(v.T, order, axis=1)
    level = (value - value[:, :1]) * impacts.LEVELS // (value[:, -1:] - value[:, :1] + 1)
    low = np.array([[r[lv == x].min() for x in lv] for r, lv in zip(value, level)])
    high = np.array([[r[lv == x].max() for x in lv] for r, lv in zip(value, level)])
    block = {"codes": v, "ranked": order, "low": low, "high": high}
    for q in (0, 5, 300, 699):
        exact = v @ v[q]
        exact[q] = -(2**60)
        want = np.lexsort((np.arange(len(v)), -exact))[:5]
        for bound in (None, int(exact[want[-1]]), int(exact[want[0]])):
            at, score = impacts.best_of_block(block, v[q], bound, q, 5)
            keep = want if bound is None else want[exact[want] >= bound]
            assert at.tolist() == keep.tolist() and score.tolist() == exact[keep].tolist()
        assert impacts.best_of_block(block, v[q], int(exact.max()) + 1, q, 5)[0].tolist() == []


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (50, [0.5, -1.0]), (50, [0.5, -1.0]), (None, [2.0, 2.0]), (1, None), (2, [nan, 1.0]), (100, [inf, 1.0]), (3, [None, 1.0]), (4, []), (5, [1.0]), (6, [0.1, 0.1, 0.7]), (7, [1.0, 0.5]), (8, [1e6, -1e6])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"score": F.lit(1), "RANK": F.lit(2)})
    got = impacts.topk_search(df, F.col("vec_id") % 50 == 0)
    assert got.columns == ["query_vec_id", "rank", "vec_id", "score"]
    used = [(k, np.pad(np.floor(256 * np.array(v, np.float32).astype(np.float64)), (0, 3 - len(v))).astype(np.int64)) for k, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = top_by_hand(used, [i for i, r in enumerate(used) if r[0] is not None and r[0] % 50 == 0])
    assert sorted((tuple(r) for r in got.collect()), key=str) == want and len(want) == 15
    assert impacts.topk_search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert impacts.topk_search(df.where("vec_id = 0"), F.lit(True)).count() == 0  # no other row
    assert impacts.topk_search(df, F.lit(False)).count() == 0
    with pytest.raises(ValueError, match="64 bits"):
        impacts.topk_search(spark.createDataFrame([(1, [1e12])], "vec_id long, embedding array<double>"), F.lit(True))


def test_many_copies_keep_few_rows(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(2000)] + [(2000 + i, [0.0, i / 1000, 1.0]) for i in range(100)]
    got = impacts.topk_search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 500 == 0).collect()
    assert [r["vec_id"] for r in sorted(got, key=lambda r: (r["query_vec_id"], r["rank"]))] == [1, 2, 3, 4, 5] + [0, 1, 2, 3, 4] * 4


def ranked_by_hand(docs, items, k=20):
    """docs and items: (key, text) rows."""
    split = lambda t: TERM.findall((t or "").translate(LOWER))
    docs = [(key, split(t)) for key, t in docs]
    total, words = sum(1 for _, w in docs if w), sum(len(w) for _, w in docs)
    counts = [Counter(w) for _, w in docs]
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        terms = split(text)
        scores = []
        for (key, w), c in zip(docs, counts):
            m = 75 + (25 * len(w) * total) // max(words, 1)
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms if c[t])
            if s > 0:
                scores.append((-s, key is None, key))
        out += [(item, n, key, -s) for n, (s, _, key) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def test_query_of_words_against_brute_force(spark):
    got = queries.op13_lexical_search(spark, DIR).collect()
    docs, items = (spark.read.parquet(f"{DIR}/{t}.parquet").select(k, "text").collect() for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert sorted((tuple(r) for r in got), key=str) == ranked_by_hand(docs, items)


def test_odd_texts(spark):
    common, long = "the of and", " ".join(f"t{i % 5000}" for i in range(60_000))
    docs = [(1, None), (None, "zebra the"), (2, ""), (3, "!!! ..."), (4, "Zebra ZEBRA the of"), (5, "twice the zebra"), (5, "twice the zebra"), (6, long), *[(100 + i, f"{common} n{i}") for i in range(60)], (7, "Äpfel äpfel naïve")]
    items = [(1, "zebra the the"), (None, "zebra"), (2, None), (3, ""), (4, "absent words only"), (5, common), (5, common), (6, "t17 t4999 t17"), (7, "ÄPFEL naïve"), (8, long)]
    left = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit(1), "item_id": F.lit(9), "terms": F.lit("x")})
    right = spark.createDataFrame(items, "item_id long, text string").withColumns({"doc_id": F.lit(1), "BOUND": F.lit(2)})
    got = lexical.lexical_search(left, right)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == ranked_by_hand(docs, items)
    assert lexical.lexical_search(left.limit(0), right).count() == 0 and lexical.lexical_search(left, right.limit(0)).count() == 0
    assert lexical.lexical_search(left.where("doc_id = 1"), right).count() == 0


def test_bounds_prune_and_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(2)
    word = lambda n: " ".join(f"w{x}" for x in rng.zipf(1.3, n) % 400)
    docs, items = [(i, word(rng.integers(1, 200))) for i in range(900)], [(i, word(25)) for i in range(12)]
    monkeypatch.setattr(lexical, "DOCUMENTS", 60)
    got = lexical.lexical_search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k=5)
    assert sorted((tuple(r) for r in got.collect()), key=str) == ranked_by_hand(docs, items, 5)
