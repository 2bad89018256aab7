"""Hive-partitioned Parquet output, JSON payload output and source deletion."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pactline.sources.listing import delete_files, list_files, parquet_rows

# Fixed value: the folder value Hive and Spark give a null or empty partition value.
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"
DATE_PARTITIONS = ("year", "month", "day")


@dataclass(frozen=True)
class WriteResult:
    path: str
    basename: str
    partition_cols: tuple[str, ...]
    rows: int
    partitions: int = 0


def processing_date_columns(instant: datetime) -> dict[str, str]:
    """``year/month/day`` partition values (zero-padded text) of a UTC instant."""
    utc = instant.astimezone(timezone.utc)
    return {"year": f"{utc.year:04d}", "month": f"{utc.month:02d}", "day": f"{utc.day:02d}"}


def file_basename(prefix: str, instant: datetime) -> str:
    return f"{prefix}_{instant.astimezone(timezone.utc).strftime('%Y%m%dT%H%M%SZ')}"


def write_hive_parquet(df: DataFrame, path: str, partition_cols: list[str] | tuple[str, ...] = (),
                       instant: datetime | None = None, file_prefix: str = "part",
                       mode: str = "append", token: str | None = None) -> WriteResult:
    """Append ``df`` below ``path`` as ``<cols>=<v>/.../year=/month=/day=/<prefix>_<ts>-*.parquet``.

    * Partition columns absent from ``df`` are ignored; the values live in
      the path only (not in the files). A null or empty value goes to
      Hive's default partition and reads back as null.
    * One dynamic-partition write pass after a rebalance by the partition
      columns: a combination is written by as few tasks as its size needs
      (large ones are split), no per-combination rescans, no ``coalesce(1)``. File names carry the prefix and the processing
      second, plus Spark's task/job suffix, so a re-run never overwrites.
    * An empty frame writes no data file.
    * ``token`` names the writing batch in the file names; files that an earlier
      attempt with the same token and instant left below ``path`` are removed first.
    * Rows are observed during the write itself; partition combinations are
      counted exactly, from the folders of the written files.
    """
    instant = instant or datetime.now(timezone.utc)
    cols = tuple(c for c in partition_cols if c in df.columns)
    dated = df.withColumns({k: F.lit(v) for k, v in processing_date_columns(instant).items()})
    obs = Observation(f"write_{uuid.uuid4().hex}")
    if cols:
        dated = dated.hint("rebalance", *cols)
    observed = dated.observe(obs, F.count(F.lit(1)).alias("rows"))
    basename = file_basename(file_prefix, instant) + (f"-{token}" if token else "")
    if token:
        remove_attempt(df.sparkSession, path, basename)
    (observed.write.mode(mode)
     .partitionBy(*cols, *DATE_PARTITIONS)
     .option("mapreduce.output.basename", basename)
     .parquet(path))
    metrics = obs.get or {}
    rows = int(metrics.get("rows") or 0)
    result = WriteResult(path=path, basename=basename, partition_cols=cols, rows=rows)
    if not rows:
        return result
    if not cols:
        return replace(result, partitions=1)
    files = list_files(df.sparkSession, path, suffix=".parquet", prefix=f"{basename}-").files
    return replace(result, partitions=files.select(F.regexp_replace("path", "/[^/]*$", "")).distinct().count())


def read_hive_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read an output back; partition values stay text (``08`` is not ``8``)."""
    found = spark.read.option("basePath", path).parquet(path)
    return found


def written_files(spark: SparkSession, result: WriteResult) -> DataFrame:
    """``(path, rows, bytes, partition)`` of the data files one write produced.

    The output folder is listed by tasks, rows come from the files' footers,
    partition values (text; null for Hive's default partition) from their paths.
    """
    files = list_files(spark, result.path, suffix=".parquet", prefix=f"{result.basename}-").files
    pairs = F.transform(F.filter(F.split("path", "/"), lambda x: F.contains(x, F.lit("="))), lambda x: F.split(x, "=", 2))
    value = lambda p: F.when(p[1] != F.lit(HIVE_NULL), F.url_decode(F.replace(p[1], F.lit("+"), F.lit("%2B"))))
    partition = F.map_from_entries(F.transform(pairs, lambda p: F.struct(p[0], value(p))))
    return files.join(parquet_rows(files), "path").select("path", "rows", F.col("length").alias("bytes"), partition.alias("partition"))


def remove_attempt(spark: SparkSession, path: str, basename: str) -> int:
    """Delete the files below ``path`` that an unfinished attempt wrote under ``basename``."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return 0
    own = list_files(spark, path, suffix=None, prefix=f"{basename}-")
    if own.count and (left := consume(spark, own.files, "path").where("not deleted").count()):
        raise OSError(f"{left} files of an earlier attempt could not be removed below {path}")
    return own.count


def write_json_rows(df: DataFrame, path: str, mode: str = "append", token: str | None = None) -> None:
    """JSON lines output (request payloads, manifests); ``token`` as in ``write_hive_parquet``."""
    writer = df.write.mode(mode)
    if token:
        remove_attempt(df.sparkSession, path, f"rows-{token}")
        writer = writer.option("mapreduce.output.basename", f"rows-{token}")
    writer.json(path)


def consume(spark: SparkSession, paths: DataFrame, column: str = "source_path") -> DataFrame:
    """``(source_path, deleted, error)``: exactly the listed files deleted by tasks, each outcome named.

    No path passes the driver; a path that is already gone counts as deleted, so a retried task is harmless.
    The paths are dealt anew, as they may all lie in a few partitions.
    """
    return delete_files(paths.repartition(spark.sparkContext.defaultParallelism, column), column)


def delete_paths(spark: SparkSession, paths: DataFrame, column: str = "source_path") -> int:
    """Delete the listed files; the number of those that are gone."""
    return consume(spark, paths, column).where("deleted").count()
