"""pactline: contract-driven document ingestion on Spark.

A JSON contract declares where documents land, how fields are renamed,
typed, cleaned and deduplicated, which audit columns are derived and
which outputs are written; pactline compiles it once into DataFrame
expressions and runs it as a batch or incremental Spark job.
"""

from pactline.contract import Contract, load_contract, shipped_contract, shipped_endpoints

__all__ = ["Contract", "load_contract", "shipped_contract", "shipped_endpoints"]
