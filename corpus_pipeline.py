"""Corpus pipeline: five stages over ``documents``, each one an operator of ``revlens.llm``.

Every stage takes ``(spark, docs, sf_dir)``; its result is written as
Parquet below the shared checkpoint folder and read back as the next one's
``docs``.  All stages but the last return the columns of ``documents``.

1. language: texts without a letter, and texts of which no language holds
   ``MIN_SHARE``, go.
2. near duplicates: of every component of the n-gram Jaccard join the row
   with the smallest id stays.
3. decontamination: documents that hold a benchmark passage go.
4. PII: validated values are replaced by keyed pseudonyms; n_chars follows
   the new text.
5. packing: token sequences of at most 2048 ids.

Defined results for nulls, empty and very long texts, ties, repeated rows
and empty tables are those of the operators; a null text goes in stage 1;
a row with a null id and a text is a document like any other, and among
near duplicates an id comes before a null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import decontam, lang_id, ngram_join, packing, pii
from revlens.llm.common import cut, table
from revlens.llm.queries import pii_key

MIN_SHARE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, made = lang_id.identify(docs)
    keep = made["score"] >= MIN_SHARE  # a text without letters has score 0
    return docs.where(keep & (made["lang_pred"] != "und"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # By row key, not id: rows that share an id (or have none) but not the text are separate documents.
    key = ngram_join.row_key(docs)
    keyed = docs.select(key.alias("doc_id"), docs["text"].alias("text"))
    hits = decontam.find(keyed, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("hit")).distinct()
    return docs.join(hits, key == hits["hit"], "left_anti")


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return (pii.pseudonymise(docs, pii_key(spark), counts=None)
            .withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pseudonymise", pseudonymise),
    ("pack", pack),
]

# Mixture inference, Feistel networks and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
