"""Configuration documents (contract, API index, endpoint table) from any storage.

These are small single documents read on the driver, the way Spark reads
any configuration: through the cluster's file system (``file:``, ``s3a:``,
``abfs:`` ...), so the same code runs locally and on a cluster.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession

from pactline.contract import Contract, load_contract, endpoint_table


def read_json_document(spark: SparkSession, path: str) -> Any:
    """Parse one whole JSON document (``json.loads`` semantics)."""
    files = spark.read.format("binaryFile").load(path)
    sizes = files.select("length").take(2)  # metadata only: content is not read
    if len(sizes) != 1:
        raise FileNotFoundError(f"expected exactly one document at {path}, found {len(sizes)}")
    return json.loads(bytes(files.select("content").first()["content"]))


def read_contract(spark: SparkSession, path: str) -> Contract:
    return load_contract(read_json_document(spark, path))


def read_endpoints(spark: SparkSession, resources_root: str, index_key: str) -> dict[str, dict]:
    """API index -> ``unitary[0]`` -> endpoint table, both below ``resources_root``."""
    root = resources_root.rstrip("/")
    index = read_json_document(spark, f"{root}/{index_key.lstrip('/')}")
    return endpoint_table(index, lambda key: read_json_document(spark, f"{root}/{key.lstrip('/')}"))


def write_json_document(spark: SparkSession, path: str, payload: Any) -> None:
    """Write one small JSON document (run manifests) through the Hadoop file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(conf).create(target, True)
    try:
        out.write(bytearray(json.dumps(payload, ensure_ascii=False, indent=2).encode("utf-8")))
    finally:
        out.close()
