"""Corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.llm.common import drop_stage, read_table, stage_alone
from pactline.llm.decontamination import drop_contaminated
from pactline.llm.linededup import dedup_lines
from pactline.llm.neardup import keep_one
from pactline.llm.packing import op6_pack
from pactline.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects."""
    return drop_toxic(spark, docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that repeat an earlier line within one edit, short ones if equal; documents stay, ``n_chars`` follows the text."""
    out = dedup_lines(spark, docs)
    if "n_chars" in docs.columns:
        changed = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(out["n_removed"] > 0, changed).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component (five-word shingles, similarity 0.8) stays."""
    return keep_one(spark, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which benchmark windows cover a twentieth or more."""
    return drop_contaminated(spark, docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 2048 tokens: one row per piece."""
    return op6_pack(spark, docs)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("packing", packing)]

#: The classifier and the tokenizer are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and reread, and what it was made from deleted."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        made_from = docs
        docs = stage_alone(spark, lambda: function(spark, made_from, sf_dir), f"pipeline-{name}")  # noqa: B023
        drop_stage(spark, made_from)
    return STAGES[-1][1](spark, docs, sf_dir)
