"""A corpus pipeline: language ID, exact dedup, near dedup, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame: the columns of documents for all but the last. Between
stages, rows are written to the shared folder of spark.checkpoint.dir, so that a lost executor costs one stage at most.

Defined cases: nulls in any column, empty and very long texts, repeated rows and empty tables pass each stage as its
operator defines; texts without a letter are rejected by the first. Columns of any further name are kept, with their values, by all
stages but the last. The mix may take a document up to three times; it then comes that often to the packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import exact_dedup, langid, mixing, ngram_join, packing
from plumbline.llm.common import query_rows, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a letter and whose language isn't in doubt; learnt from the labelled ones that aren't held out."""
    return langid.accepted(docs, langid.learn(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup.kept_rows(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similar shingle sets the one with the smallest doc_id."""
    dropped = ngram_join.join(docs).where("component_id <> doc_id").select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.struct("*").alias("row"))
    return rows.join(dropped, "id", "left_anti").select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per packed piece."""
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("ngram_join", near), ("mixing", mix), ("packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = query_rows(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
