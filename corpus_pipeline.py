"""The corpus pipeline: quality, near-duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns the columns of ``documents`` (the
last one the packed pieces).  ``run`` writes every stage's result as Parquet to the
shared folder and reads it again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.llm.components import saved
from docketflow.llm.decontamination import find_leaks
from docketflow.llm.minhash_dedup import one_of_each
from docketflow.llm.packing import default_tokenizer, pack
from docketflow.llm.quality import classify
from docketflow.llm.substring_dedup import substring_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(found: DataFrame) -> DataFrame:
    """Back from an operator's id, text and carried columns to those of ``documents``; n_chars follows the text."""
    key = "doc_id" if "doc_id" in found.columns else "id"
    return found.select(F.col(key).alias("doc_id"), "text", "carried.lang", "carried.source", F.length("text").cast("long").alias("n_chars"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps (operator 3)."""
    found = classify(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _documents(found.where("keep"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class (operator 9)."""
    return _documents(one_of_each(docs.select(COLUMNS)))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 35 words or more that repeat (operator 1)."""
    return _documents(substring_dedup(docs.select(COLUMNS)))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark (operator 10)."""
    found = find_leaks(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _documents(found.where(F.size("leaks") == 0))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences (operator 8)."""
    found = pack(docs.select("doc_id", "text"), default_tokenizer())
    return found.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL can't express the stages; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's result over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
