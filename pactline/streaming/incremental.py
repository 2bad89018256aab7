"""Incremental landing ingest with Structured Streaming.

``readStream`` over the landing folder (``sources.landing_stream``, which does
its own listing) discovers new documents, hidden and empty ones included; each
micro-batch runs the same plan as a batch run through
``foreachBatch`` with its own run id ``<run id>-<batch id>``. One batch takes everything
that landed before the run, so dedup covers it as in a batch run:
``trigger(availableNow=True)`` processes it and stops, so a scheduler can run it
like a batch job while the checkpoint remembers which files were already taken.

Consumption of the good documents is the run's own consume-after-commit delete;
unreadable ones stay in place for investigation.

Each finished batch leaves a marker under the checkpoint location; a batch
that Spark re-delivers after a restart (offsets not committed yet) is
skipped when its marker exists. Before it writes anything, a batch notes its
run id and instant; a batch that failed between its writes and its marker
runs again under the same run id and instant and first removes the files of
its own earlier attempt, so no row is written twice. The marker precedes
the consume-after-commit delete: a failure between the two leaves sources in
place, with nothing lost or doubled.

On stores that tasks can't list (``sources.listing.reachable``) the stream is Spark's
``binaryFile`` source, which sees neither hidden names nor empty files.
"""

from __future__ import annotations

import hashlib
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pactline.operators.audit import RunContext
from pactline.plans.pipeline import BatchConfig, BatchResult, document_limit, process_parsed
from pactline.session import apply_defaults
from pactline.sources.config import read_json_document, write_json_document
from pactline.sources.documents import parse_binary_documents
from pactline.sources.landing import BINARY_FILE_SCHEMA, JSON_GLOB
from pactline.sources.landing_stream import landing_stream
from pactline.sources.listing import qualified, reachable


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def _noted(spark: SparkSession, path: str) -> RunContext | None:
    """Run id and instant of a batch's earlier attempt; a note cut short was followed by no write."""
    if not _exists(spark, path):
        return None
    try:
        note = read_json_document(spark, path)
    except (ValueError, FileNotFoundError):
        return None
    return RunContext(run_id=note["run_id"], now=datetime.fromisoformat(note["now"]))


def documents_stream(spark: SparkSession, path: str, checkpoint_location: str) -> DataFrame:
    if reachable(qualified(spark, path)) and reachable(qualified(spark, checkpoint_location)):
        return landing_stream(spark, path, f"{checkpoint_location.rstrip('/')}/_pactline_listings", document_limit(spark))
    return (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", JSON_GLOB)
              .option("recursiveFileLookup", "true").load(path))


def start_incremental(spark: SparkSession, cfg: BatchConfig, checkpoint_location: str, run_id: str,
                      now: datetime | None = None, results: list[BatchResult] | None = None,
                      keep_stages: bool = False) -> StreamingQuery:
    """Start the incremental ingest; returns the running query."""
    apply_defaults(spark)
    fields = cfg.contract.read_fields

    done_root = f"{checkpoint_location.rstrip('/')}/_pactline_done"

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        # Batch ids are stable for a checkpoint: a batch re-delivered after a
        # restart (its offsets not yet committed) is skipped once finished.
        marker = f"{done_root}/{batch_id}.json"
        if _exists(batch.sparkSession, marker):
            return
        started = f"{done_root}/{batch_id}.started.json"
        ctx = _noted(batch.sparkSession, started)
        if ctx is None:
            ctx = RunContext(run_id=f"{run_id}-{batch_id}", now=now or datetime.now(timezone.utc))
            write_json_document(batch.sparkSession, started, {"run_id": ctx.run_id, "now": ctx.now.isoformat()})
        token = hashlib.sha256(f"{checkpoint_location}\x1f{ctx.run_id}".encode()).hexdigest()[:16]

        def finished(done: BatchResult) -> None:
            write_json_document(batch.sparkSession, marker, {"batch_id": batch_id, "run_id": ctx.run_id, **done.manifest()})

        parsed = parse_binary_documents(batch, fields, json_fields=cfg.contract.json_fields)
        res = process_parsed(batch.sparkSession, replace(cfg), parsed, ctx, token, finished)
        if cfg.delete_sources:
            finished(res)  # now with the number of sources deleted
        if not keep_stages:
            res.drop_stages(batch.sparkSession)
        if results is not None:
            results.append(res)

    return (documents_stream(spark, cfg.landing_path, checkpoint_location).writeStream
            .foreachBatch(each_batch)
            .option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True)
            .start())
