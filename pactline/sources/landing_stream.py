"""Streaming source over a landing folder that does its own listing.

Spark's file stream source sees neither hidden names nor empty files. Here each
offset is the number of a listing journal: a table of the files (path, length,
time) that were new, or had changed, when the folder was listed. A micro-batch is the
journals between two offsets; tasks read slices of them and the files they name, so
neither offsets nor plans hold paths, and every landed file reaches one batch, empty and
hidden ones too. Journals lie below the checkpoint location: after a restart they
say what has been taken.

The listing runs where Spark plans the stream and keeps the paths that lie in
the folder at that time; consumed files leave it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pactline.sources.listing import JSON_SUFFIX, READ_FILES, qualified, reading, storage

FORMAT = "landed_documents"
SCHEMA = "path string, length long, content binary"


def landing_source() -> type:
    """The data source class, built here so that it is shipped by value."""
    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    resolve, read, suffix, schema, name = storage(), reading(), JSON_SUFFIX, SCHEMA, FORMAT

    class Slice(InputPartition):
        def __init__(self, listing: int, start: int, end: int) -> None:
            self.listing, self.start, self.end = listing, start, end

    class Reader(DataSourceStreamReader):
        def __init__(self, options) -> None:
            self.root, self.journal = options["path"], options["journal"].rstrip("/")
            self.limit, self.slice = int(options["limit"]), int(options["slice"])
            self.seen: dict[str, tuple] | None = None
            self.last = 0

        def _journals(self):
            from pyarrow import fs

            system, path, _ = resolve(self.journal)
            system.create_dir(path, recursive=True)
            infos = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
            return system, path, sorted(int(i.base_name.split(".")[0]) for i in infos if i.base_name.endswith(".parquet"))

        def _listed(self) -> dict[str, tuple]:
            from pyarrow import fs

            system, path, back = resolve(self.root)
            found, waiting = {}, [path]
            while waiting:
                for info in system.get_file_info(fs.FileSelector(waiting.pop(), allow_not_found=True)):
                    if info.type == fs.FileType.Directory:
                        waiting.append(info.path)
                    elif info.base_name.lower().endswith(suffix):
                        found[back + info.path] = (info.size, info.mtime_ns)
            return found

        def initialOffset(self) -> dict:
            return {"listing": 0}

        def latestOffset(self) -> dict:
            import pyarrow as pa
            import pyarrow.parquet as pq

            system, path, numbers = self._journals()
            if self.seen is None:
                self.seen = {}
                for n in numbers:
                    with system.open_input_file(f"{path}/{n}.parquet") as source:
                        table = pq.read_table(source)
                    self.seen.update(zip(table["path"].to_pylist(), zip(table["length"].to_pylist(), table["modified"].to_pylist(), strict=True), strict=True))
                self.last = numbers[-1] if numbers else 0
            now = self._listed()
            new = sorted(p for p, state in now.items() if self.seen.get(p) != state)
            if new:
                table = pa.table({"path": new, "length": [now[p][0] for p in new], "modified": [now[p][1] for p in new]})
                part = f"{path}/{self.last + 1}.writing"
                with system.open_output_stream(part) as out:
                    pq.write_table(table, out, row_group_size=self.slice)
                system.move(part, f"{path}/{self.last + 1}.parquet")
                self.last += 1
            self.seen = now
            return {"listing": self.last}

        def partitions(self, start: dict, end: dict) -> list:
            import pyarrow.parquet as pq

            system, path, _ = self._journals()
            slices = []
            for n in range(start["listing"] + 1, end["listing"] + 1):
                with system.open_input_file(f"{path}/{n}.parquet") as source:
                    rows = pq.ParquetFile(source).metadata.num_rows
                slices += [Slice(n, at, min(at + self.slice, rows)) for at in range(0, rows, self.slice)]
            return slices

        def read(self, partition: Slice):
            import pyarrow.parquet as pq

            system, path, _ = resolve(self.journal)
            with system.open_input_file(f"{path}/{partition.listing}.parquet") as source:
                table = pq.ParquetFile(source).read_row_group(partition.start // self.slice, columns=["path", "length"])
            rows = list(zip(table["path"].to_pylist(), table["length"].to_pylist(), strict=True))
            yield from read(rows, self.limit, False)

        def commit(self, end: dict) -> None:
            pass

    class Landing(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def streamReader(self, schema) -> Reader:
            return Reader(self.options)

    return Landing


def landing_stream(spark: SparkSession, path: str, journal: str, limit: int, slice_files: int = READ_FILES) -> DataFrame:
    """``(path, length, content)`` of every landed document as a stream; ``journal`` is a folder of the stream's own."""
    spark.dataSource.register(landing_source())
    return (spark.readStream.format(FORMAT).option("path", qualified(spark, path)).option("journal", qualified(spark, journal))
            .option("limit", str(limit)).option("slice", str(slice_files)).load())
