"""The corpus pipeline: language, near duplicates, benchmark passages, secrets, packing.

Each stage is a function of the session, the documents its predecessor kept and the folder of the tables. All but the last
return the columns of documents. ``run`` writes each stage's rows as Parquet below the shared folder and hands them on.

Rows of equal doc_id and text count as one document, of which the smallest row in the order of its columns stays; different texts
of one doc_id are different documents. Documents without a doc_id are kept by the second stage, which cannot name them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.llm import decontamination, language, near_duplicates, packing, secrets
from tapeline.llm.tables import stored, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told by dictionaries of the labelled ones."""
    return language.told(docs, language.learn(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document of smallest id, of equal ids the one whose text has the smallest hash."""
    mark = F.xxhash64("doc_id", "text")
    repeated = stored(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    named = docs.where("doc_id is not null").select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("key"))
    if not repeated.isEmpty():
        # different texts of one id are different documents: each gets a number of its own
        again = docs.join(repeated, "doc_id", "left_semi").select(F.struct(*docs.columns).alias("row"), (-1 - F.shiftrightunsigned(mark, 1)).alias("key"))
        once = docs.where("doc_id is not null").join(repeated, "doc_id", "left_anti")
        named = once.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("key")).unionAll(again.groupBy("key").agg(F.min("row").alias("row")).select("row", "key"))
        named = stored(named, "named")
    found = near_duplicates.near_duplicates(named.select("key", F.col("row.text").alias("text")), "key")
    if repeated.isEmpty():
        first = found.where("key = component_id").select("key")
    else:
        ids = found.join(named.select("key", F.col("row.doc_id").alias("id")), "key")
        first = ids.groupBy("component_id").agg(F.min(F.struct("id", "key")).alias("first")).select("first.key")
    kept = named.join(first, "key", "left_semi").select("row.*")
    return kept.unionAll(docs.where("doc_id is null").select(*docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold most of a benchmark item."""
    return decontamination.cleaned(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced and n_chars counted anew."""
    network = secrets.learn(stored(secrets.candidates(docs), "candidates"))
    return secrets.redacted(docs, network).withColumn("n_chars", F.length("text").cast("long"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their place."""
    return packing.pack(stored(packing.pieces(docs), "pieces"))


STAGES = [
    ("language_id", language_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("best_fit_packing", packing_stage),
]

#: Compression, a trained network and a tokenizer cannot be written in SQL; tests/llm holds the operators, not the chain, against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
