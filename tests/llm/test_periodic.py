"""Periodic runs against brute force, as operator and as query, and on odd rows."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from upkeep.llm import periodic, queries

DIR = "/root/testdata/sf0.001"


def brute(w, least=24, times=3):
    """All maximal runs by their least period, every period tried at every place."""
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


@pytest.mark.parametrize("least,times", [(24, 3), (6, 2), (9, 3), (30, 5)])
def test_runs_of_random_words(least, times):
    rng = np.random.default_rng(least)
    for _ in range(60):
        docs = []
        for _ in range(rng.integers(1, 6)):
            n, a, p = rng.integers(0, 180), rng.integers(0, 40), rng.integers(1, 40)
            w = rng.integers(0, rng.integers(1, 4), n)
            docs.append(np.array([w[i if i < a or rng.random() < 0.005 else a + (i - a) % p] for i in range(n)]) if n > a + p else w)
        at = np.append(0, np.cumsum([len(w) for w in docs])).astype(np.int64)
        got = periodic.runs_of(np.concatenate(docs).astype(np.int64), at, least, times)
        assert [tuple(r) for r in got.tolist()] == [(i, *r) for i, w in enumerate(docs) for r in brute(w.tolist(), least, times)]


def test_fibonacci_words_and_one_word():
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    at = np.array([0, len(b)])
    assert [tuple(r[1:]) for r in periodic.runs_of(np.array(b), at).tolist()] == brute(b)
    assert periodic.runs_of(np.zeros(50_000, np.int64), np.array([0, 50_000])).tolist() == [[0, 0, 50_000, 1]]


def test_query_against_brute_force(spark):
    got = {r["doc_id"]: r.asDict() for r in queries.op11_periodic_runs(spark, DIR).collect()}
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs) and any(r["n_runs"] for r in got.values())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for d in docs:
        w = (d["text"] or "").encode().split()
        w = [x.decode() for x in w]
        h = zlib.crc32(str(d["doc_id"]).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute(w)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None, None, None)
        assert got[d["doc_id"]] == {
            "doc_id": d["doc_id"], "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2], "exponent_milli": 1000 * best[1] // best[2] if runs else None,
            "runs_sha256": sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), "collapsed_sha256": sha(collapsed(w, runs))}


def test_odd_rows(spark):
    line = " ".join(f"w{i}" for i in range(12))
    long = " ".join(f"v{i}" for i in range(60_000)) + (" " + line) * 500
    rows = [(1, None), (None, f"{line} " * 3), (2, ""), (3, "one"), (4, " \t\n\x0b\x0c\r "), (5, "a " * 24), (5, "a " * 24), (6, long), (7, "a " * 23), (8, "x y z " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"runs": F.lit(1), "N_WORDS": F.lit(2), "source": F.lit("s")})
    got = periodic.periodic_runs(df).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and got[0]["source"] == "s" and set(got[0].asDict()) == {"doc_id", "text", "source", *periodic.MADE}
    tell = lambda k: (by[k]["n_words"], [tuple(r) for r in by[k]["runs"]], by[k]["strongest"] and tuple(by[k]["strongest"]), by[k]["collapsed"])
    assert tell(1) == tell(2) == tell(4) == (0, [], None, "") and tell(3) == (1, [], None, "one")
    assert tell(None) == (36, [(0, 36, 12)], (0, 36, 12), line) and tell(5) == (24, [(0, 24, 1)], (0, 24, 1), "a")
    assert tell(7)[1] == [] and tell(8) == (30, [(0, 30, 1)], (0, 30, 1), "x y z")
    assert tell(6)[:3] == (66_000, [(60_000, 6_000, 12)], (60_000, 6_000, 12)) and tell(6)[3] == " ".join(f"v{i}" for i in range(60_000)) + " " + line
    empty = periodic.periodic_runs(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", *periodic.MADE]
    with pytest.raises(ValueError):
        periodic.periodic_runs(df, min_exponent=1)
