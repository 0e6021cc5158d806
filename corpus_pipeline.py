"""The corpus pipeline: quality rules, toxicity, line de-duplication, near
duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all
its predecessor kept, and all but the last return the columns of ``documents``.
``run`` writes every stage below ``spark.checkpoint.dir`` and reads it back.

Defined results: rows that a stage does not reject stay, also with null or empty
text where the stage keeps those (the quality rules reject texts of few words);
after line de-duplication ``n_chars`` is the length of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm.common import read, written
from vitals.llm.line_dedup import dedup_lines
from vitals.llm.near_dedup import drop_near
from vitals.llm.packing import production
from vitals.llm.quality_rules import keep_good
from vitals.llm.toxicity import drop_toxic


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return keep_good(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the labels of ``sf_dir`` train the score."""
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; every document stays."""
    out = dedup_lines(docs).drop("n_lines", "n_dropped")
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five words, 0.8)."""
    return drop_near(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences, one row per piece."""
    return production(docs)


STAGES = [("quality_rules", quality), ("toxicity", toxicity), ("line_dedup", line_dedup),
          ("near_dedup", near_dedup), ("packing", packing)]

#: learned scores and tokenizers are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
