"""Landing folders: every ``*.json`` document under a prefix, one row per file.

Tasks list and read the files (``sources.listing``); stores that only Spark's
readers reach go through a ``binaryFile`` scan instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.sources.documents import EMPTY, parse_binary_documents
from pactline.sources.listing import Listed, list_files, qualified, reachable, read_files

# Case-insensitive ``.json`` suffix, as a Hadoop glob.
JSON_GLOB = "*.[jJ][sS][oO][nN]"

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def scan_files(spark: SparkSession, path: str) -> DataFrame:
    """``binaryFile`` scan of every JSON document below ``path`` (recursive).

    Each file is one row and one task input split, so the scan spreads over
    the cluster like any file source; ``spark.sql.files.maxPartitionBytes``
    and ``openCostInBytes`` pack small documents into tasks.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", JSON_GLOB)
        .option("recursiveFileLookup", "true")
        .load(path)
    )


def uri_to_path(uri: Column) -> Column:
    """Percent-encoded file URI -> the form a scan's ``path`` column has (Spark SQL).

    ``url_decode`` is form decoding (``+`` means a blank), so literal ``+``
    is escaped first; an empty authority (``file:///x``) becomes ``file:/x``.
    """
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")


@dataclass(frozen=True)
class Listing:
    """The scan's file listing, kept in the JVM: a count and a one-column frame."""

    count: int
    paths: DataFrame


def listing(files: DataFrame) -> Listing:
    """Every file the scan's index listed, zero-length ones included.

    ``inputFiles`` is the listing Spark's file index already holds on the
    driver; it is turned into a Dataset inside the JVM (no per-path
    round trips through Python) and decoded to scan-path form in SQL.
    """
    spark = files.sparkSession
    jvm = spark.sparkContext._jvm
    uris = files._jdf.inputFiles()
    seq = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(uris)
    jds = spark._jsparkSession.createDataset(seq, jvm.org.apache.spark.sql.Encoders.STRING())
    frame = DataFrame(jds.toDF(), spark).select(uri_to_path(F.col("value")).alias("source_path"))
    return Listing(count=len(uris), paths=frame)


def missing_from_scan(listed: Listing, seen: DataFrame) -> DataFrame:
    """Listed files that no scan split read: zero-length documents, status ``empty``.

    Spark plans no split for an empty file, so it never reaches the scan.
    Only paths are compared (a left-anti join against the scanned paths);
    callers skip this when the listed and scanned counts agree.
    """
    return listed.paths.join(seen.select("source_path"), "source_path", "left_anti").select(
        "source_path", F.lit(EMPTY).alias("status"))


def read_scanned(spark: SparkSession, path: str, fields: list[str], max_bytes: int | None = None,
                 json_fields: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """The ``binaryFile`` way, for stores that tasks can't list themselves: hidden names stay unseen."""
    files = scan_files(spark, path)
    listed = listing(files)
    parsed = parse_binary_documents(files, fields, max_bytes, json_fields)
    # Compared with a second scan of the paths alone: its content column is
    # pruned, whereas ``parsed.select("source_path")`` would read and parse again.
    seen = scan_files(spark, path).select(F.col("path").alias("source_path"))
    empties = missing_from_scan(listed, seen).select(
        "source_path", "status", F.lit(None).cast(parsed.schema["rec"].dataType).alias("rec"))
    return parsed.unionByName(empties), listed.count


def read_listed(listed: Listed, fields: list[str], max_bytes: int | None = None, json_fields: tuple[str, ...] = ()) -> DataFrame:
    """``(source_path, status, rec)`` of listed files: read by tasks, empty and oversized ones reported unread."""
    limit = max_bytes if max_bytes is not None else (1 << 31) - 1
    return parse_binary_documents(read_files(listed, limit), fields, json_fields=json_fields)


def land(spark: SparkSession, path: str, fields: list[str], max_bytes: int | None = None,
         stages: list[str] | None = None, json_fields: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """``(source_path, status, rec)`` of every JSON document below ``path``, and their number.

    Hidden names and empty files count like any other. Listing tables are appended to ``stages``.
    """
    if not reachable(qualified(spark, path)):
        return read_scanned(spark, path, fields, max_bytes, json_fields)
    listed = list_files(spark, path, stages=stages)
    return read_listed(listed, fields, max_bytes, json_fields), listed.count


def read_landing(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """``(source_path, status, rec)`` for every landed document, hidden and empty files included."""
    return land(spark, path, fields)[0]
