"""Registered queries of this folder: each applies one operator to its whole table and derives the agreed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.llm import alignment, decontamination, embedding_links, language, licenses, near_duplicates, packing, periodic_runs, quality_model, quality_rules, secrets, substring_dedup, url_filter
from tapeline.llm.tables import rest, stored, table


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    dictionaries = language.learn(docs.where(rest("doc_id", 4) != 2))
    judged = language.identify(docs, dictionaries)
    return judged.select("doc_id", F.coalesce(rest("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    measured = stored(quality_rules.statistics(table(spark, folder, "documents")), "statistics")
    judged = quality_rules.judge(measured)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality_model.learn(docs, labels.where((rest("doc_id", 3) != 1) & (F.col("quality") == 1)))
    return quality_model.score(docs, model).select("doc_id", (rest("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, folder, "documents"))


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = stored(secrets.candidates(table(spark, folder, "documents")), "candidates")
    return secrets.findings(found, secrets.learn(found)).drop("places")


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents"))


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return url_filter.judge(pages, url_filter.listed_hosts(pages))


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(stored(packing.pieces(table(spark, folder, "documents")), "pieces"))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.matched(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_embedding_links(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_links.near_duplicates(table(spark, folder, "embeddings"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.collapsed(table(spark, folder, "documents"), texts=False)


def op13_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    x.__name__: x
    for x in (
        op1_language_id,
        op2_quality_rules,
        op3_quality_classifier,
        op4_substring_dedup,
        op5_secret_scan,
        op6_near_duplicates,
        op7_url_filter,
        op8_best_fit_packing,
        op9_license_scan,
        op10_decontamination,
        op11_embedding_links,
        op12_periodic_runs,
        op13_tokenizer_alignment,
    )
}

ORACLE: dict[str, str] = {"op6_near_duplicates": near_duplicates.oracle(), "op7_url_filter": url_filter.oracle(), "op11_embedding_links": embedding_links.oracle()}
