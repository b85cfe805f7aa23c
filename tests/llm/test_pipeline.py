"""Stages of the pipeline on small tables, and odd rows through all of them."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from upkeep.llm import suffix

DIR = "/root/testdata/sf0.001"


def test_cut_letters_go_and_others_stay(spark):
    shared = "é" * 200
    rows = [(1, "x�y " + shared + " one"), (2, "zz" + shared + "� two"), (3, "� alone"), (4, None)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in corpus_pipeline.suffix_dedup(spark, docs, DIR).collect()}
    assert {k: r["text"] for k, r in got.items()} == {1: "x�y  one", 2: "zz� two", 3: "� alone", 4: None}
    assert got[1]["n_chars"] == len("x�y  one") and set(got[1].asDict()) == set(docs.columns)


def test_whole_letters_widen_runs(spark):
    a, b = "é" + "q" * 100, "è" + "q" * 100  # equal from the middle of a letter on
    df = spark.createDataFrame([(1, "1" + a), (2, "2" + b)], "doc_id long, text string")
    halves = suffix.suffix_dedup(df, min_bytes=64).orderBy("doc_id").collect()
    whole = suffix.suffix_dedup(df, min_bytes=64, whole_letters=True).orderBy("doc_id").collect()
    assert [bytes(r["kept"]) for r in halves] == [b"1\xc3\xa9", b"2\xc3\xa8"] and [bytes(r["kept"]).decode() for r in whole] == ["1é", "2è"]
    c = spark.createDataFrame([(1, "1" + "漢" * 40), (2, "2" + "漣" + "漢" * 39)], "doc_id long, text string")  # last bytes of a first letter are equal
    got = suffix.suffix_dedup(c, min_bytes=64, whole_letters=True).collect()
    assert {bytes(r["kept"]).decode() for r in got} <= {"1", "2", "1漢", "2漣"}


def test_mix_keeps_what_it_takes_and_rows_without_words(spark):
    rows = [(i, "word " * 50, "en", "a", 250) for i in range(40)] + [(100 + i, "other " * 50, "en", "b", 300) for i in range(40)] + [(200, None, "en", "a", None), (201, "", "en", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.source_mixing(spark, docs, DIR).collect()
    assert all(r["taken"] > 0 or r["size"] == 0 for r in got) and {200, 201} <= {r["doc_id"] for r in got}
    assert len(got) < len(rows) and sum(r["taken"] for r in got) == pytest.approx(4000, rel=0.05)


def test_run_on_the_smallest_tables(spark):
    out = corpus_pipeline.run(spark, DIR)
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    assert set(docs.columns) <= set(out.columns)
    kept = out.join(docs.select("doc_id", F.col("text").alias("before")), "doc_id")
    assert 0 < kept.count() == out.count() < docs.count()
    assert kept.where("length(text) > length(before)").count() == 0
    assert out.where("n_chars <> length(text)").count() == 0 and out.groupBy("text").count().where("count > 1 AND length(text) > 0").count() == 0
