"""A corpus pipeline of five stages: quality rules, line dedup, near duplicates, personal data, packing.

Each stage takes all that the stage before it kept. The last one returns sequences; the others return documents with the
columns they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from takerlens.llm.op1_pii import mask_personal_data
from takerlens.llm.op5_templates import drop_templates
from takerlens.llm.op6_packing import pack_documents
from takerlens.llm.op7_jaccard import keep_one
from takerlens.llm.op9_isolation import keep_good
from takerlens.llm.staging import documents, for_texts, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest."""
    return keep_good(docs, for_texts(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines whose template recurs in a document with a smaller id."""
    for_texts(spark)
    return drop_templates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: the one with the smallest id."""
    for_texts(spark)
    return keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked by its kind."""
    for_texts(spark)
    return mask_personal_data(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    for_texts(spark)
    return pack_documents(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("personal_data", personal_data), ("packing", packing)]

# A forest grown at random, MinHash candidates and a tokenizer are beyond SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
