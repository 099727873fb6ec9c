"""A training-data pipeline over ``documents``: filter, deduplicate, mix, pack.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, in few partitions to write. All but the last return the columns of ``docs``. ``run``
applies them in order, each written as Parquet and read again as the next
one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import minhash, mixing, packing, rules, substring
from lodestar.llm._common import few_files, scratch, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules (operator 7)."""
    return few_files(rules.accepted(docs, rules.trusted_ids(spark, sf_dir)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates (operator 8)."""
    return few_files(minhash.deduplicated(docs))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the passages that repeat (operator 10)."""
    return few_files(substring.without_repeats(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, each as often as its source's target weight takes it (operator 3)."""
    return few_files(mixing.mixed(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, placed in sequences (operator 5)."""
    return few_files(packing.packed(docs, packing.default_tokenizer()).withColumnRenamed("id", "doc_id"))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup),
          ("substring_dedup", substring_dedup), ("mix", mix), ("pack", pack)]

#: The stages hash with functions that DuckDB lacks; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(spark, step(spark, docs, sf_dir), root, name)
    return docs
