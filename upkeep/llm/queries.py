"""The registered queries of this package and their SQL for DuckDB."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.llm import chat, decontaminate, fingerprint, impacts, language, lexical, licenses, mixing, neardup, periodic, quality, suffix, warc
from upkeep.llm.common import scratch_path
from upkeep.llm.oracles import O  # noqa: F401

def held_out() -> Column:
    """True for rows that no model learns from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_array_dedup(spark, d):
    out = suffix.suffix_dedup(table(spark, d, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_order_minhash(spark, d):
    return neardup.near_classes(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", "class_id", "class_size", "is_first")


def op3_warc_writer(spark, d):
    folder = scratch_path(spark, "warc")
    warc.write_warc(table(spark, d, "pages"), folder)
    return warc.read_warc(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_source_mixing(spark, d):
    return mixing.mix(table(spark, d, "documents").select("doc_id", "text", "source"), quality=weights(spark, d)).select(
        "doc_id", "size", "source_size", "target", "taken")


def weights(spark, d):
    """(doc_id, weight): 2 for documents labelled good, 0.5 for those labelled bad."""
    return table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).alias("weight"))


def op5_license_scan(spark, d):
    return licenses.license_scan(table(spark, d, "documents").select("doc_id", "text")).drop("text")


def op6_decontamination(spark, d):
    out = decontaminate.decontaminate(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op7_chat_formatting(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    # Two rows of the template's own control strings, beside the table's.
    own = turns.sparkSession.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    out = chat.format_chat(turns.unionByName(own))
    out = out.select("conv_id", chat.read_chat(F.col("formatted")).alias("turns"), chat.masked_text(F.col("segments")).alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op8_quality_classifier(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, table(spark, d, "labels").where(~held_out()))
    return quality.score_quality(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op9_weighted_sampling(spark, d):
    out = fingerprint.edited_fingerprints(table(spark, d, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_chars", "edited_sha256", fingerprint.as_text(F.col("signature")).alias("fingerprint"), fingerprint.as_text(F.col("edited_signature")).alias("edited_fingerprint"),
                      fingerprint.likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"), fingerprint.likeness(F.col("signature"), F.col("next_signature")).alias("near_next"))


def op10_language_id(spark, d):
    docs = table(spark, d, "documents")
    model = language.fit_language(docs.where(~held_out()))
    return language.identify_language(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op11_periodic_runs(spark, d):
    out = periodic.periodic_runs(repeating(table(spark, d, "documents").select("doc_id", "text")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.col("strongest")
    return out.select("doc_id", "n_runs", "strongest.start", "strongest.length", "strongest.period", F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
                      F.sha2(F.concat(F.array_join(line, "\n"), F.when(best.isNotNull(), "\n").otherwise("")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def repeating(docs):
    """One document of ten, by the hash of its id, with its words from some place on replaced by a repeating stretch."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.withColumns({"h": h, "w": F.when(h % 10 == 0, F.array_remove(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), ""))})
    docs = docs.withColumns({"n": F.size("w"), "g": F.expr("h div 10")})
    docs = docs.withColumn("a", F.expr("IF(n > 0, CAST(g % n AS int), 0)")).withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS int)"))
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.expr("CAST((n - a) div p + 1 AS int)")))
    words = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(again, F.lit(1), F.col("n") - F.col("a")))
    return docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def op12_topk_search(spark, d):
    out = impacts.topk_search(table(spark, d, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)
    return out.withColumnRenamed("query_vec_id", "query_id")


def op13_lexical_search(spark, d):
    return lexical.lexical_search(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "benchmark").select("item_id", "text"))


def pipeline(spark, d):
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)


Q = {f.__name__: f for f in (op1_suffix_array_dedup, op2_order_minhash, op3_warc_writer, op4_source_mixing, op5_license_scan, op6_decontamination,
                             op7_chat_formatting, op8_quality_classifier, op9_weighted_sampling, op10_language_id, op11_periodic_runs, op12_topk_search,
                             op13_lexical_search, pipeline)}
