"""Run journal of batch runs: a run that died is finished, not repeated.

One note per landing location says how far a run came:

* ``started`` (run id, instant, token): it may have written some files. The next
  run takes its place under the same id, instant and token; writing with a
  token first removes what an earlier attempt with that token wrote.
* ``written``: outputs and requests are complete and the paths to consume are
  stored beside the note. The next run only deletes these (again, if need
  be) and then starts afresh, so nothing is read twice and nothing lost.
* ``finished``: nothing to take up.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from pactline.operators.audit import RunContext
from pactline.sinks.parquet import consume
from pactline.sources.config import read_json_document, write_json_document

STARTED, WRITTEN, FINISHED = "started", "written", "finished"


@dataclass
class Journal:
    spark: SparkSession
    folder: str
    ctx: RunContext | None = None
    token: str | None = None
    sources: str | None = None

    def _path(self) -> str:
        return f"{self.folder.rstrip('/')}/run.json"

    def _note(self, phase: str) -> None:
        write_json_document(self.spark, self._path(), {
            "phase": phase, "run_id": self.ctx.run_id, "now": self.ctx.now.isoformat(), "token": self.token, "sources": self.sources})

    def _read(self) -> dict:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self._path())
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return {}
        try:
            return read_json_document(self.spark, self._path())
        except ValueError:  # a note cut short: the run died before it had done anything under it
            return {}

    def begin(self, ctx: RunContext) -> RunContext:
        """Finish what an earlier run left, then note this run's start; returns the context to run under."""
        note = self._read()
        if note.get("phase") == WRITTEN:
            left = consume(self.spark, self.spark.read.parquet(note["sources"])).where("not deleted").count()
            if left:
                raise OSError(f"{left} sources of run {note['run_id']} could not be deleted; its outputs are complete")
        if note.get("phase") == STARTED:
            self.ctx, self.token = RunContext(note["run_id"], datetime.fromisoformat(note["now"])), note["token"]
        else:
            self.ctx = ctx
            self.token = hashlib.sha256(f"{self.folder}\x1f{ctx.run_id}\x1f{uuid.uuid4()}".encode()).hexdigest()[:16]
            self._note(STARTED)
        return self.ctx

    def written(self, sources: DataFrame | None) -> None:
        """Outputs are complete; ``sources`` (source_path) are what the run will consume, if anything."""
        if sources is not None:
            self.sources = f"{self.folder.rstrip('/')}/sources-{self.token}"
            sources.write.mode("overwrite").parquet(self.sources)
            self._note(WRITTEN)

    def finished(self) -> None:
        self._note(FINISHED)
