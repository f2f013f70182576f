"""From documents to packed sequences, one corpus operator per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etlkit.llm.common import staged, table, without
from etlkit.llm.decontaminate import find_leaks
from etlkit.llm.language import identify_documents, train
from etlkit.llm.line_dedup import drop_repeated_lines
from etlkit.llm.ngram_join import near_groups
from etlkit.llm.packing import pack


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is found go. Languages are learnt from the labelled documents given."""
    languages, model = train(docs)
    found = identify_documents(docs, languages, model)
    return without(docs, found.where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct(), "doc_id")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines leave the texts; documents go if nothing but such lines was in them."""
    cleaned = drop_repeated_lines(docs).where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    return cleaned.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    groups = near_groups(docs)
    return without(docs, groups.where("component_id <> doc_id").select("doc_id").distinct(), "doc_id")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    leaks = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, leaks.select("doc_id").where("doc_id IS NOT NULL").distinct(), "doc_id")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place."""
    return pack(docs)


STAGES = [("language_id", identify_language), ("line_dedup", drop_lines), ("ngram_jaccard_join", drop_near_copies),
          ("benchmark_decontamination", drop_leaks), ("best_fit_packing", pack_sequences)]

# Language identification, decontamination and packing are not expressible in SQL; tests check each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
