"""Benchmark items without an id mark documents as others do."""

from upkeep.llm import decontaminate


def test_null_items_count_but_are_not_named(spark):
    long, short = " ".join(f"null{i}" for i in range(12)), "no key here"
    bench = spark.createDataFrame([(None, long), (None, short), (1, long), (2, "another item")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"a {long} b"), (2, f"so {short} it is"), (3, "clean words"), (4, "another item")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["items"], r["contaminated"]) for r in decontaminate.decontaminate(docs, bench).collect()}
    assert got == {1: (12, ["1"], True), 2: (3, [], True), 3: (0, [], False), 4: (2, ["2"], True)}
