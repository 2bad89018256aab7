"""Distributed listing, reading and deleting of landed files.

Spark's own file index runs on the driver, leaves out names that begin with
``_`` or ``.`` and plans no split for empty files. Here folders are listed by tasks:
a frontier table of folders is expanded until a task's budget of entries is used
up, and what it has not reached becomes the next round's frontier. So a small
landing zone takes one round, a large tree spreads over the cluster, and paths
stay in tables: none passes the driver or stands in a plan.

Files are read and deleted by tasks through pyarrow's file systems (local, S3,
HDFS, GCS, ABFS). Other stores keep Spark's ``binaryFile`` scan (``sources.landing``).
All task code is closures shipped by value: executors need no copy of this package.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.session import scratch_path

JSON_SUFFIX = ".json"
#: entries one task lists before it hands the folders left to the next round
ENTRY_BUDGET = 20_000
READ_BYTES = 128 << 20  # documents of so many bytes, or so many documents, are read by one task
READ_FILES = 4_000
#: scheme of a landing location -> scheme of pyarrow's file system
SCHEMES = {"": "file", "file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "hdfs": "hdfs", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def qualified(spark: SparkSession, location: str) -> str:
    """The location with its scheme, as the deployment's default file system and working folder give it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def reachable(location: str) -> bool:
    """Whether tasks can list and read the (qualified) location themselves."""
    return urlsplit(location).scheme in SCHEMES


def storage() -> Callable:
    """A function from a location to (file system, path in it, prefix that makes such a path a location again)."""
    schemes = dict(SCHEMES)

    def resolve(location: str):
        from pyarrow import fs

        head, found, rest = location.partition(":")
        if not found or "/" in head:
            return fs.LocalFileSystem(), location, "file:"
        scheme = schemes[head]
        if scheme == "file":
            return fs.LocalFileSystem(), "/" + rest.lstrip("/"), "file:"
        authority, _, key = rest.lstrip("/").partition("/")
        system, _ = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
        if scheme in ("s3", "gs"):  # a path begins with the bucket
            return system, f"{authority}/{key}".rstrip("/"), f"{head}://"
        return system, f"/{key}", f"{head}://{authority}"

    return resolve


def _list_folders(suffix: str | None, prefix: str | None, budget: int) -> Callable:
    """Task: folders -> (path, length, modified, folder) of their files, and of folders left for the next round."""
    resolve = storage()

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        names = ["path", "length", "modified", "folder"]
        types = [pa.string(), pa.int64(), pa.timestamp("us", tz="UTC"), pa.bool_()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for folders in batches:
            for location in folders.column(0).to_pylist():
                system, path, back = resolve(location)
                waiting, seen, rows = [path], 0, []
                while waiting:
                    if seen >= budget:
                        rows += [(back + p, 0, None, True) for p in waiting]
                        break
                    for info in system.get_file_info(fs.FileSelector(waiting.pop(), allow_not_found=True)):
                        seen += 1
                        if info.type == fs.FileType.Directory:
                            waiting.append(info.path)
                        elif (suffix is None or info.base_name.lower().endswith(suffix)) and (prefix is None or info.base_name.startswith(prefix)):
                            rows.append((back + info.path, info.size, info.mtime, False))
                    if len(rows) >= 5_000:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    return run


LISTED = "path string, length long, modified timestamp, folder boolean"


@dataclass
class Listed:
    """Files below a location: a table of (path, length, modified), their number and bytes."""

    files: DataFrame
    count: int
    bytes: int
    stages: list[str] = field(default_factory=list)


def list_files(spark: SparkSession, location: str, suffix: str | None = JSON_SUFFIX, prefix: str | None = None,
               budget: int = ENTRY_BUDGET, stages: list[str] | None = None) -> Listed:
    """Every file below ``location`` with the suffix (any case) and name prefix: hidden and empty ones included.

    A location that does not exist has no files. The tables are appended to ``stages``.
    """
    stages = [] if stages is None else stages
    frontier = spark.createDataFrame([(qualified(spark, location),)], "path string")
    found: DataFrame | None = None
    while True:
        path = scratch_path(spark, "listing")
        spread = frontier.repartition(max(1, spark.sparkContext.defaultParallelism)) if found is not None else frontier
        spread.mapInArrow(_list_folders(suffix, prefix, budget), LISTED).write.parquet(path)
        stages.append(path)
        now = spark.read.schema(LISTED).parquet(path)
        files = now.where("not folder").drop("folder")
        found = files if found is None else found.unionByName(files)
        frontier = now.where("folder").select("path")
        if frontier.isEmpty():
            break
    total = found.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("b")).first()
    return Listed(files=found, count=int(total["n"]), bytes=int(total["b"]), stages=stages)


def reading() -> Callable:
    """A function from (location, length, limit) rows to (path, length, content) record batches of bounded size.

    Empty files are not opened; the content of a file above the limit is null, and
    so are content and length (-1) of a file that has gone.
    """
    resolve = storage()

    def read(rows, limit, lost_is_error):
        import pyarrow as pa

        def batch(found):
            paths, lengths, contents = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(lengths, pa.int64()), pa.array(contents, pa.binary())], names=["path", "length", "content"])

        systems: dict[str, tuple] = {}
        found, size = [], 0
        for location, length in rows:
            content = b"" if length == 0 else None
            if 0 < length <= limit:
                root = location.split("/", 3)[2] if "://" in location else ""
                if root not in systems:
                    system, _, back = resolve(location)
                    systems[root] = (system, back)
                system, back = systems[root]
                try:
                    with system.open_input_stream(location[len(back):]) as source:
                        content = source.read()
                    length = len(content)
                except FileNotFoundError:
                    if lost_is_error:
                        raise
                    length = -1
            found.append((location, length, content))
            size += len(content or b"")
            if size >= 16 << 20 or len(found) >= 500:
                yield batch(found)
                found, size = [], 0
        if found:
            yield batch(found)

    return read


def read_files(listed: Listed, limit: int) -> DataFrame:
    """``(path, length, content)`` of listed files, spread by their number and bytes; a file that went away fails the run."""
    spark = listed.files.sparkSession
    read = reading()

    def run(batches):
        for batch in batches:
            yield from read(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), limit, True)

    tasks = max(spark.sparkContext.defaultParallelism, -(-listed.bytes // READ_BYTES), -(-listed.count // READ_FILES))
    return listed.files.select("path", "length").repartition(tasks, "path").mapInArrow(run, "path string, length long, content binary")


def _delete_files(threads: int) -> Callable:
    resolve = storage()

    def run(batches):
        from concurrent.futures import ThreadPoolExecutor

        import pyarrow as pa

        systems: dict[str, tuple] = {}

        def delete(location):
            try:
                root = location.split("/", 3)[2] if "://" in location else ""
                if root not in systems:
                    system, _, back = resolve(location)
                    systems[root] = (system, back)
                system, back = systems[root]
                system.delete_file(location[len(back):])
            except FileNotFoundError:
                return True, None  # an earlier attempt of this task deleted it
            except Exception as error:  # noqa: BLE001 - the outcome names the path and the error
                return False, f"{type(error).__name__}: {error}"
            return True, None

        with ThreadPoolExecutor(max_workers=threads) as pool:
            for listed in batches:
                paths = listed.column(0).to_pylist()
                done = list(pool.map(delete, paths))
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array([d for d, _ in done], pa.bool_()), pa.array([e for _, e in done], pa.string())], names=["source_path", "deleted", "error"])

    return run


def delete_files(paths: DataFrame, column: str = "source_path", threads: int = 16) -> DataFrame:
    """``(source_path, deleted, error)``: every path deleted by a task, each outcome named.

    Lazy and safe to run again: a path that is already gone counts as deleted.
    """
    return paths.select(F.col(column).alias("source_path")).mapInArrow(_delete_files(threads), "source_path string, deleted boolean, error string")


def _read_footers() -> Callable:
    resolve = storage()

    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        for listed in batches:
            paths = listed.column(0).to_pylist()
            rows = []
            for location in paths:
                system, path, _ = resolve(location)
                with system.open_input_file(path) as source:
                    rows.append(pq.ParquetFile(source).metadata.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(rows, pa.int64())], names=["path", "rows"])

    return run


def parquet_rows(files: DataFrame) -> DataFrame:
    """``(path, rows)`` of Parquet files, from their footers, read by tasks."""
    return files.select("path").mapInArrow(_read_footers(), "path string, rows long")


def _write_contents(root: str) -> Callable:
    resolve = storage()

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        system, base, back = resolve(root)
        local = isinstance(system, fs.LocalFileSystem)
        for batch in batches:
            paths, contents = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for name, content in zip(paths, contents, strict=True):
                path = f"{base}/{name}"
                if local:
                    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(path) as out:
                    out.write(content or b"")
            yield pa.RecordBatch.from_arrays([pa.array([f"{back}{base}/{p}" for p in paths], pa.string())], names=["path"])

    return run


def write_files(documents: DataFrame, location: str) -> DataFrame:
    """``documents(name, content binary)`` as one file each below ``location``, written by tasks; returns ``(path)``, lazily."""
    root = qualified(documents.sparkSession, location)
    return documents.select("name", F.col("content").cast("binary").alias("content")).mapInArrow(_write_contents(root), "path string")
