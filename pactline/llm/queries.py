"""The registered ``opN_<name>`` queries and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pactline.llm import alignment, conversations, decontamination, fingerprints, html_extract, linededup, lm, mixing, neardup, packing, repeats, sharding, toxicity
from pactline.llm.common import read_table


def op1_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.op1_lines(spark, read_table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(spark, read_table(spark, sf_dir, "documents"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(spark, read_table(spark, sf_dir, "pages"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op4_shards(spark, read_table(spark, sf_dir, "documents"))


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.op5_lm(spark, read_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op6_pack(spark, read_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op7_toxicity(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.op8_repeats(spark, read_table(spark, sf_dir, "documents"))


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.op9_neardup(spark, read_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.op10_contamination(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op11_mix(spark, read_table(spark, sf_dir, "documents"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.op12_repair(spark, read_table(spark, sf_dir, "conversations"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(spark, read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_linededup, op2_fingerprints, op3_html, op4_sharding, op5_lm, op6_packing, op7_toxicity, op8_repeats, op9_neardup, op10_decontamination, op11_mixing, op12_repair, op13_alignment)
}

ORACLE_SQL = {"op1_linededup": linededup.ORACLE, "op10_decontamination": decontamination.ORACLE, "op11_mixing": mixing.ORACLE}
