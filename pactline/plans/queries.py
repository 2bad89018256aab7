"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

All of them read the given test tables (or data Spark derives from them)
in full. Contract-driven ones run on the landing documents derived from
``conversations`` with a fixed run id and processing instant, so their
output is reproducible and comparable with the SQL in ``oracle``.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.contract import shipped_contract, shipped_endpoints
from pactline.operators.audit import RunContext
from pactline.plans import stages
from pactline.session import apply_defaults
from pactline.sources.testdata import landing_documents

# Run constants of the registered queries.
RUN_ID = "run-20260821T153045Z"
NOW = datetime(2026, 8, 21, 15, 30, 45, tzinfo=timezone.utc)
CTX = RunContext(run_id=RUN_ID, now=NOW)


def _landing_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the good landing documents (each parsed once)."""
    apply_defaults(spark)
    return stages.good_docs(landing_documents(spark, sf_dir), shipped_contract())


def _landing_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.mapped(_landing_good(spark, sf_dir), shipped_contract())


def _landing_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.deduped(_landing_mapped(spark, sf_dir), shipped_contract())


def contract_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: landing documents -> parse -> map/cast/clean -> dedup -> audit -> core."""
    return stages.outputs(_landing_deduped(spark, sf_dir), shipped_contract(), CTX)[0]


def contract_atts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EAV output: 18 attribute rows per surviving record."""
    return stages.outputs(_landing_deduped(spark, sf_dir), shipped_contract(), CTX)[1]


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep-latest per trace id: the surviving business rows."""
    return _landing_deduped(spark, sf_dir).select(
        "source_path", "interaccion_id", "interaccion_fecha_fin", "consumidor_nombre", "interaccion_resultado"
    )


# Fixed value: the records that share one dedup key in ``dedup_hot_key``.
HOT_RULE = "conv_id % 3 = 0"


def dedup_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep-latest when one key holds a third of all records (skew)."""
    apply_defaults(spark)
    contract = shipped_contract()
    docs = landing_documents(spark, sf_dir, hot_key=F.expr(HOT_RULE))
    deduped = stages.deduped(stages.mapped(stages.good_docs(docs, contract), contract), contract)
    return deduped.select("source_path", "interaccion_id", "interaccion_fecha_fin", "consumidor_nombre")


def distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pactline.operators.requests import conversation_ids

    return conversation_ids(_landing_mapped(spark, sf_dir))


def request_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    req = stages.requests(_landing_mapped(spark, sf_dir), shipped_endpoints())
    return req.select("conversation_id", "endpoint", "request_context.*")


QUERIES = {
    "contract_core": contract_core,
    "contract_atts": contract_atts,
    "dedup_latest": dedup_latest,
    "dedup_hot_key": dedup_hot_key,
    "distinct_ids": distinct_ids,
    "request_fanout": request_fanout,
}


def all_queries() -> dict:
    from pactline.plans.io_queries import QUERIES as IO
    from pactline.plans.operator_queries import QUERIES as OPS

    return {**QUERIES, **OPS, **IO}
