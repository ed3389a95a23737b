"""Training-data pipeline: quality rules, line dedup, near duplicates, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
stage's docs. ``run`` applies them to ``documents``. ORACLE_SQL is None: the bounds of line chunks and the fingerprints
rest on XXH64, which DuckDB's SQL has no function for; tests compare the operators behind the stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import decontaminate, lines, mixing, quality, simhash
from factloom.llm.common import shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above their host's limit are gone from the others."""
    return quality.clean(docs.select(COLUMNS))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines are gone but for their first place; no document goes."""
    return lines.dedup_lines(docs.select(COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the least id."""
    return simhash.keep_one(docs.select(COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a hit word go."""
    return decontaminate.drop_contaminated(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it, repeats counted."""
    return mixing.mix(docs.select(COLUMNS)).select("doc_id", F.col("source"), "size", "source_size", "target", "taken")


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("near dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixture)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
