"""The share of equal samples estimates the generalised Jaccard similarity, frequent words included."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from upkeep.llm import fingerprint


def _likeness(spark, pairs, rounds):
    rows = [(2 * i + j, t) for i, p in enumerate(pairs) for j, t in enumerate(p)]
    made = fingerprint.fingerprint(spark.createDataFrame(rows, "doc_id long, text string"), rounds=rounds).select("doc_id", "signature")
    one, two = (made.where(F.col("doc_id") % 2 == j).select(F.expr("doc_id div 2").alias("pair"), F.col("signature").alias(f"s{j}")) for j in (0, 1))
    return {r[0]: r[1] for r in one.join(two, "pair").select("pair", fingerprint.likeness(F.col("s0"), F.col("s1"))).collect()}


def test_frequent_words_keep_their_weight(spark):
    def own(i, j):
        return " ".join(f"p{i}own{j}x{k}" for k in range(40))

    pairs = [(f"w{i} " * 1000 + own(i, 0), f"w{i} " * 1000 + own(i, 1)) for i in range(30)]  # 1000 / 1080
    pairs += [(f"w{i} " * 600 + own(i, 0), f"w{i} " * 200 + own(i, 1)) for i in range(30, 60)]  # 200 / 680
    got = _likeness(spark, pairs, 64)
    error = np.array([got[i] - (1000 / 1080 if i < 30 else 200 / 680) for i in range(60)])
    assert abs(error[:30].mean()) < 0.025 and abs(error[30:].mean()) < 0.04 and np.quantile(np.abs(error), 0.99) < 0.2


def test_parts_do_not_change_signatures(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"a b {i % 7} c{i % 5} " * (1 + i % 3)) for i in range(60)], "doc_id long, text string")
    one = {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprint(df).collect()}
    monkeypatch.setattr(fingerprint, "RANGE_ROWS", 7)
    assert one == {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprint(df).collect()}
    assert len(one) == 60 and _likeness(spark, [("x y", "x y"), ("x", "y")], 64) == {0: pytest.approx(1), 1: pytest.approx(0)}


def test_draws_are_compiled(spark):
    """No draw walks through a lambda for each term and round."""
    docs = spark.createDataFrame([(1, "a b b c"), (2, "a b b d")], "doc_id long, text string")
    near = fingerprint.signatures(docs.withColumn("part", F.lit(0)), "part", "doc_id")
    assert "lambdafunction" not in near._jdf.queryExecution().executedPlan().toString()
    one, two = (r["signature"] for r in near.orderBy("doc_id").collect())
    assert abs(sum(x == y for x, y in zip(one, two)) / 64 - 3 / 5) < 0.2  # (1 + 2) of (1 + 2 + 1 + 1)
