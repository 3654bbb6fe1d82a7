"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import conversations, decontaminate, html, langid, lm, neardup, notices, packing, phrases, quality, search, substring, toxicity
from wardflow.llm.common import fold_of, table


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring.remove_repeats(spark, table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0), lambda total, s: total + s["end"] - s["begin"]).cast("long")
    return cleaned.select("doc_id", "text", "spans", removed.alias("n_removed"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(spark, table(spark, sf_dir, "pages"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(spark, table(spark, sf_dir, "documents"), fold_of(F.col("doc_id"), 5) != 1)


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    asked = documents.where(F.col("doc_id") % 50 == 0).select(F.col("doc_id").alias("query_id"), "text")
    return search.top_k(spark, documents, asked, k=10)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold_of(F.col("doc_id"), 5) == 0
    scored = toxicity.score(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold_of(F.col("doc_id"), 3) == 1
    scored = quality.score(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(spark, table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = fold_of(F.col("doc_id"), 4) == 2
    contents = langid.train(documents, ~held_out)
    judged = langid.identify(documents, contents)
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(spark, table(spark, sf_dir, "documents"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices.summary(notices.find_notices(table(spark, sf_dir, "documents")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    return conversations.report(spark, given, conversations.damage(given))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_html_extraction": op5_html_extraction,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_decontamination": op9_decontamination,
    "op10_language_id": op10_language_id,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_license_scan": op12_license_scan,
    "op13_conversation_repair": op13_conversation_repair,
}
