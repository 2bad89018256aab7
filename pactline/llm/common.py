"""Helpers shared by the operators: table access, staged tables, byte-level word splitting."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dir: list[str] = []
_staged: dict[str, list[str]] = {}

#: Byte table for words ``[^\x20\x09-\x0D]+``: lower-case A-Z only (``bytes.split`` does the rest).
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Byte table for words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z: other ASCII becomes a blank.
ALNUM_LOWER = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; an own folder only on a local master where it is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="llm-stages-"))
        atexit.register(shutil.rmtree, _own_dir[0], ignore_errors=True)
    return f"file://{_own_dir[0]}"


def stage(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a compressed table below the shared folder and read it back: cuts lineage, survives executors."""
    path = f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_path = path
    return out


def drop_stage(spark: SparkSession, df: DataFrame | None) -> None:
    """Delete one staged table that no later plan reads."""
    path = getattr(df, "_llm_path", None)
    if path:
        _delete(spark, path)


def stage_alone(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """``stage`` of what ``make`` returns; the tables staged on the way are deleted once it is written."""
    before = set(_staged.get(spark.sparkContext.applicationId, []))
    out = stage(spark, make(), label)
    for path in [p for p in _staged[spark.sparkContext.applicationId] if p not in before and p != out._llm_path]:
        _delete(spark, path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    _staged[spark.sparkContext.applicationId].remove(path)


def drop_stages(spark: SparkSession) -> None:
    """Delete every staged table of this application; lazy results that read them end with it."""
    for path in list(_staged.get(spark.sparkContext.applicationId, [])):
        _delete(spark, path)


def text_of(docs: DataFrame):
    """The text column with null as empty."""
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
