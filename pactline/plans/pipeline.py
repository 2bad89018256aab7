"""Batch run of a contract: land -> parse -> map/clean -> dedup -> audit -> write x2 -> requests -> consume.

Plan shape (one run):

* stage 1 (narrow): listed files, read by tasks -> strict parse -> status ->
  map/cast/clean. This staged frame (typed business columns next to the
  status) is materialised once (a Parquet table below the shared
  ``spark.checkpoint.dir`` by default), because it feeds the dedup, the
  quarantine report, the ids and the delete list.
* stage 2: keep-best window (one shuffle on the record key, pre-trimmed
  map side). The deduplicated frame is materialised too: two outputs
  branch from it.
* core and atts are projections / a generator of that frame: no shuffle.
* ids: ``distinct`` (partial aggregation, then one small shuffle),
  materialized once with its count; the request rows are built from it.
* the two output writes and the ids/requests chain are independent jobs,
  submitted concurrently.

Failure semantics: a strict cast error fails the run before anything is
written. Sources are deleted only after both outputs and the request rows
are written, and only the ones that were read successfully. Without a journal
delivery is at-least-once: a failure after the writes and before the delete
leaves the sources in place, and a re-run appends again. With ``journal_path``
the next run takes up what a dead one left, and no row is written twice.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from typing import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pactline.contract import Contract
from pactline.operators.audit import RunContext
from pactline.operators.requests import build_requests, conversation_ids
from pactline.plans import stages
from pactline.plans.journal import Journal
from pactline.session import apply_defaults, ensure_checkpoint_dir, scratch_path
from pactline.sinks.parquet import WriteResult, consume, write_hive_parquet, write_json_rows, written_files
from pactline.sources.config import write_json_document
from pactline.sources.documents import OK
from pactline.sources.landing import land


def materialize(df: DataFrame, how: str = "table", name: str = "stage",
                metrics: list[Column] | None = None, stages: list[str] | None = None) -> tuple[DataFrame, dict]:
    """Cut lineage once a frame feeds several branches; returns (frame, metrics).

    ``table`` (default): one pass writing Parquet below the shared
    ``spark.checkpoint.dir``, read back; survives executor loss without
    recomputation. ``checkpoint``: ``DataFrame.checkpoint`` into the same
    folder (computes its input twice). ``persist``: executor memory and
    disk (recomputed from the sources if an executor is lost). ``none``:
    recompute per branch. ``metrics`` (aggregate Columns) are observed
    during that same pass, so counting costs no extra job. Table paths are
    appended to ``stages`` so the run can drop them when done.
    """
    obs = Observation(f"{name}_{uuid.uuid4().hex[:8]}") if metrics else None
    src = df.observe(obs, *metrics) if obs else df
    if how == "table":
        path = scratch_path(df.sparkSession, name)
        if stages is not None:
            stages.append(path)
        # zstd: staged documents are mostly text, written and read back once per run.
        src.write.mode("errorifexists").option("compression", "zstd").parquet(path)
        out = df.sparkSession.read.parquet(path)
    elif how == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        out = src.checkpoint(eager=True)
    elif how == "persist":
        out = src.persist(StorageLevel.MEMORY_AND_DISK)
        out.count()
    elif how == "none":
        out = df
        if obs:
            src.write.format("noop").mode("overwrite").save()
    else:
        raise ValueError(f"unknown materialisation {how!r}")
    return out, (dict(obs.get) if obs else {})


@dataclass
class BatchConfig:
    contract: Contract
    landing_path: str
    core_path: str
    atts_path: str
    # The endpoint table, or a function loading it (called only when a run
    # has documents to build requests for).
    endpoints: Mapping[str, Mapping] | Callable[[], Mapping[str, Mapping]] = field(default_factory=dict)
    requests_path: str | None = None
    delete_sources: bool = False
    options: stages.Options = field(default_factory=stages.Options)
    materialize: str = "table"
    manifest_path: str | None = None
    # Folder of a run journal of the landing location's own: a run that died is finished, not repeated.
    journal_path: str | None = None


@dataclass
class BatchResult:
    processed_files: int = 0
    skipped_files: DataFrame | None = None
    skipped_count: int = 0
    core: WriteResult | None = None
    atts: WriteResult | None = None
    requests: DataFrame | None = None
    conversation_ids: int = 0
    deleted_source_files: int = 0
    # (source_path, deleted, error) of every source the run consumed; None if it consumes nothing.
    consumed: DataFrame | None = None
    # (source_path) of what will be consumed, once all outputs are written.
    sources: DataFrame | None = None
    failed_deletes: int = 0
    # Records that an ``on_cast_error="quarantine"`` run set aside: (source_path, column, text, reason).
    cast_errors: DataFrame | None = None
    cast_error_records: int = 0
    stage_paths: list[str] = field(default_factory=list)

    def drop_stages(self, spark: SparkSession) -> None:
        """Delete the run's staging tables (the returned lazy frames read them)."""
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in self.stage_paths:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
        self.stage_paths = []

    def written(self, spark: SparkSession) -> DataFrame:
        """(output, path, rows, bytes, partition) of every data file the run wrote, from the files' footers."""
        parts = [written_files(spark, w).withColumn("output", F.lit(n)) for n, w in (("core", self.core), ("atts", self.atts)) if w and w.rows]
        if not parts:
            return spark.createDataFrame([], "output string, path string, rows long, bytes long, partition map<string,string>")
        both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return both.select("output", "path", "rows", "bytes", "partition")

    def manifest(self) -> dict:
        return {
            "processed_files": self.processed_files,
            "skipped_files": self.skipped_count,
            "core_rows": self.core.rows if self.core else 0,
            "atts_rows": self.atts.rows if self.atts else 0,
            "conversation_ids": self.conversation_ids,
            "deleted_source_files": self.deleted_source_files,
            "failed_deletes": self.failed_deletes,
            "cast_error_records": self.cast_error_records,
            "output_core_path": self.core.path if self.core else None,
            "output_atts_path": self.atts.path if self.atts else None,
            "output_core_partitions": self.core.partitions if self.core else 0,
            "output_atts_partitions": self.atts.partitions if self.atts else 0,
        }


def process_parsed(spark: SparkSession, cfg: BatchConfig, parsed: DataFrame, ctx: RunContext,
                   token: str | None = None, before_consume: Callable[[BatchResult], None] | None = None,
                   stage_paths: list[str] | None = None) -> BatchResult:
    """Everything after the scan; shared by the batch run and each micro-batch.

    A run that raises drops its staging tables first. With ``token``, outputs
    replace what an earlier attempt of the same batch wrote; ``before_consume``
    is called once all outputs are written, before any source is deleted.
    ``stage_paths`` are tables that ``parsed`` reads; they go with the run's own.
    """
    result = BatchResult(stage_paths=stage_paths if stage_paths is not None else [])
    try:
        return _process(spark, cfg, parsed, ctx, result, token, before_consume)
    except BaseException:
        result.drop_stages(spark)
        raise


def _process(spark: SparkSession, cfg: BatchConfig, parsed: DataFrame, ctx: RunContext,
             result: BatchResult, token: str | None, before_consume: Callable[[BatchResult], None] | None) -> BatchResult:
    """The steps of ``process_parsed``."""
    is_ok = F.col("status") == F.lit(OK)
    stage_paths = result.stage_paths
    # Map/cast/clean once, in the scan's stage, next to the status; a strict
    # cast error stops the run here, before any output is written.
    opts = cfg.options
    staged = stages.mapped(parsed, cfg.contract, opts, keep=("source_path", "status"))
    bad_cast = (F.size(stages.ERRORS) > 0) if opts.on_cast_error == "quarantine" else F.lit(False)
    staged, counts = materialize(staged, cfg.materialize, "staged", [
        F.count_if(is_ok & ~bad_cast).alias("ok"), F.count_if(~is_ok).alias("bad"), F.count_if(is_ok & bad_cast).alias("cast")], stage_paths)
    result.processed_files, result.skipped_count = int(counts.get("ok") or 0), int(counts.get("bad") or 0)
    result.cast_error_records = int(counts.get("cast") or 0)
    result.skipped_files = stages.quarantine(staged)
    mapped = stages.good(staged).drop("status")
    if opts.on_cast_error == "quarantine":
        result.cast_errors = stages.cast_errors(mapped)
        mapped = stages.castable(mapped)
    ids = conversation_ids(mapped)
    endpoints = cfg.endpoints() if callable(cfg.endpoints) else cfg.endpoints
    if result.processed_files:
        deduped, _ = materialize(stages.deduped(mapped, cfg.contract), cfg.materialize, "deduped", stages=stage_paths)
        core, atts = stages.outputs(deduped, cfg.contract, ctx)
        parts = cfg.contract.partitions

        def write_core() -> None:
            result.core = write_hive_parquet(core, cfg.core_path, parts, ctx.now,
                                             cfg.contract.core.file_prefix, token=token)

        def write_atts() -> None:
            result.atts = write_hive_parquet(atts, cfg.atts_path, parts, ctx.now,
                                             cfg.contract.atts.file_prefix, token=token)

        def ids_and_requests() -> None:
            staged, id_counts = materialize(ids, cfg.materialize, "ids", [F.count(F.lit(1)).alias("n")], stage_paths)
            result.conversation_ids = int(id_counts.get("n") or 0)
            result.requests = build_requests(staged, endpoints)
            if cfg.requests_path:
                # Endpoint-major, ids ascending: a range-partitioned sort, no single task.
                ordered = result.requests.orderBy("endpoint_order", "conversation_id").drop("endpoint_order")
                write_json_rows(ordered, cfg.requests_path, token=token)

        # Independent jobs over materialized tables, submitted together so
        # their tails overlap; any failure is raised before sources are touched.
        run_concurrently([write_core, write_atts, ids_and_requests])
    else:
        result.requests = build_requests(ids, endpoints)
    if cfg.delete_sources and result.processed_files:
        result.sources = mapped.select("source_path")
    if before_consume:
        before_consume(result)
    if cfg.delete_sources and result.processed_files:
        result.consumed, gone = materialize(
            consume(spark, mapped.select("source_path")), "table" if cfg.materialize == "none" else cfg.materialize, "consumed",
            [F.count_if("deleted").alias("deleted"), F.count_if(~F.col("deleted")).alias("failed")], stage_paths)
        result.deleted_source_files, result.failed_deletes = int(gone.get("deleted") or 0), int(gone.get("failed") or 0)
    if cfg.manifest_path:
        write_json_document(spark, f"{cfg.manifest_path.rstrip('/')}/run_{ctx.run_id}.json",
                            {"run_id": ctx.run_id, "processed_at": ctx.now.isoformat(), **result.manifest()})
    return result


def run_concurrently(jobs: list) -> None:
    """Run driver-side job submissions in parallel threads; re-raise the first failure."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(job) for job in jobs]
    for f in futures:
        f.result()


def document_limit(spark: SparkSession) -> int:
    """The engine's own bound on one value (2 GiB); larger files are reported as ``too_large``, never read."""
    return int(spark.conf.get("spark.sql.sources.binaryFile.maxLength", str(2**31 - 1)))


def run_batch(spark: SparkSession, cfg: BatchConfig, ctx: RunContext | None = None) -> BatchResult:
    """One batch run over everything that has landed below ``cfg.landing_path``."""
    apply_defaults(spark)
    ctx = ctx or RunContext.fresh()
    journal = Journal(spark, cfg.journal_path) if cfg.journal_path else None
    if journal:
        ctx = journal.begin(ctx)
    stage_paths: list[str] = []
    parsed, landed = land(spark, cfg.landing_path, cfg.contract.read_fields, document_limit(spark), stage_paths,
                          cfg.contract.json_fields)
    if not landed:
        empty = BatchResult(skipped_files=spark.createDataFrame([], "source_path string, reason string"), stage_paths=stage_paths)
        empty.drop_stages(spark)
        if journal:
            journal.finished()
        return empty
    if not journal:
        return process_parsed(spark, cfg, parsed, ctx, stage_paths=stage_paths)
    result = process_parsed(spark, cfg, parsed, ctx, journal.token, lambda done: journal.written(done.sources), stage_paths)
    journal.finished()
    return result
