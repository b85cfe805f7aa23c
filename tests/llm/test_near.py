"""Near-duplicates under common passages, against all pairs."""

import numpy as np
import pytest

from upkeep.llm import neardup


def classes(spark, texts):
    got = neardup.near_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return {r["doc_id"]: r["class_id"] for r in got}


@pytest.mark.parametrize("passage", [152, 158])  # of 196 shingles: 0.76 and 0.79
def test_pairs_beside_a_common_passage(spark, passage):
    shared = [f"w{i}" for i in range(passage)]
    texts = []
    for k in range(750):  # two texts with 176 of 216 shingles in common, 0.81
        own = [f"{k}x{i}" for i in range(200 - passage)]
        texts += [" ".join(shared + own), " ".join(shared + own[:-20] + [f"{k}y{i}" for i in range(20)])]
    assert classes(spark, texts) == {i: i - i % 2 for i in range(1500)}


def test_moved_and_repeated_parts(spark):
    rng = np.random.default_rng(3)
    texts = []
    for k in range(40):
        parts = [[f"{k}p{p}w{i}" for i in range(100)] for p in range(10)]
        flat = lambda order: " ".join(w for p in order for w in parts[p])
        texts += [flat(range(10)), flat([*range(3, 10), 0, 1, 2]), flat(rng.permutation(10)), flat([*range(10), *[4] * 20])]
    assert classes(spark, texts) == {i: i - i % 4 for i in range(160)}


def test_aligned_texts_of_different_shingles_stay_apart(spark):
    texts = []
    for k in range(30):
        words = [f"{k}w{i}" for i in range(1000)]
        texts += [" ".join(words), " ".join(words[:800] + [f"{k}x{i}" for i in range(200)]), " ".join(f"{k}y{i}" if i % 6 == 0 else w for i, w in enumerate(words))]
    assert classes(spark, texts) == {i: i for i in range(90)}


def test_classes_are_the_components_of_all_similar_pairs(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_classes(rows).collect()}
    rows = rows.collect()
    hashes = [neardup.word_hashes(np.frombuffer(r["text"].encode(), np.uint8), np.array([0, len(r["text"].encode())]))[0].tolist() for r in rows]
    sets = [{tuple(h[i : i + 5]) for i in range(max(1, len(h) - 4))} if h else {r["text"]} for h, r in zip(hashes, rows)]
    want = {r["doc_id"]: r["doc_id"] for r in rows}
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                x, y = sorted((want[rows[i]["doc_id"]], want[rows[j]["doc_id"]]))
                want = {k: x if v == y else v for k, v in want.items()}
    assert got == want and len(set(want.values())) < len(want)
