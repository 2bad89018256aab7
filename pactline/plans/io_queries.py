"""Queries that go through storage: written outputs read back, file scans, streaming.

Each one writes below a fresh folder of the shared checkpoint folder
(``spark.checkpoint.dir``), never a machine-local temporary folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.contract import shipped_contract, shipped_endpoints
from pactline.plans import stages
from pactline.plans.pipeline import BatchConfig, run_batch
from pactline.plans.queries import CTX, NOW, RUN_ID, contract_core
from pactline.session import apply_defaults, scratch_path
from pactline.sinks.parquet import read_hive_parquet, write_hive_parquet, written_files
from pactline.sources.landing import read_landing
from pactline.sources.listing import list_files, qualified
from pactline.sources.testdata import DOCUMENT_FIELDS, landing_records, table, write_landing_files
from pactline.streaming.incremental import start_incremental


def partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written Hive-partitioned (null and empty values included) and read back."""
    apply_defaults(spark)
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    src = o.select(
        "o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority",
        F.when(k % 13 == 0, F.lit(None)).when(k % 17 == 0, F.lit("")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    out = scratch_path(spark, "orders_parts")
    write_hive_parquet(src, out, ["o_orderstatus", "o_orderpriority", "not_a_column"], NOW, "orders")
    return read_hive_parquet(spark, out)


def declared_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The core output after the typed write, read back from storage."""
    contract = shipped_contract()
    out = scratch_path(spark, "core")
    write_hive_parquet(contract_core(spark, sf_dir), out, contract.partitions, NOW,
                       contract.core.file_prefix)
    return read_hive_parquet(spark, out)


def atts_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The EAV output after the typed, partitioned write, read back from storage."""
    from pactline.plans.queries import contract_atts

    contract = shipped_contract()
    out = scratch_path(spark, "atts")
    write_hive_parquet(contract_atts(spark, sf_dir), out, contract.partitions, NOW,
                       contract.atts.file_prefix)
    return read_hive_parquet(spark, out)


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing documents as files -> Structured Streaming (availableNow) -> core output.

    The surrogate depends on the scratch folder's name, so it is compared here with
    the digest of the path its row came from; every other column is returned.
    """
    apply_defaults(spark)
    root = scratch_path(spark, "incremental")
    landing = write_landing_files(spark, sf_dir, f"{root}/landing")
    cfg = BatchConfig(contract=shipped_contract(), landing_path=landing, core_path=f"{root}/core",
                      atts_path=f"{root}/atts", endpoints=shipped_endpoints())
    query = start_incremental(spark, cfg, f"{root}/_checkpoint", RUN_ID, now=NOW)
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    core = read_hive_parquet(spark, cfg.core_path)
    source = F.concat(F.lit(qualified(spark, landing) + "/"), F.col("base_nombre"))
    surrogate = F.sha2(F.concat_ws("\x1f", F.lit(f"{RUN_ID}-0"), F.lit("registro_id"), source), 256)
    linked = F.sha2(F.concat_ws("#", "cargue_id", "registro_id"), 256)
    return core.withColumns({"registro_id": F.col("registro_id") == surrogate, "registro_hash": F.col("registro_hash") == linked})


def run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full batch run over landed files: counts of what was read, written and consumed."""
    apply_defaults(spark)
    root = scratch_path(spark, "batch")
    landing = write_landing_files(spark, sf_dir, f"{root}/landing")
    cfg = BatchConfig(contract=shipped_contract(), landing_path=landing, core_path=f"{root}/core",
                      atts_path=f"{root}/atts", endpoints=shipped_endpoints(),
                      requests_path=f"{root}/requests", delete_sources=True)
    result = run_batch(spark, cfg, CTX)
    m = result.manifest()
    keys = ["processed_files", "skipped_files", "core_rows", "atts_rows", "conversation_ids", "deleted_source_files",
            "failed_deletes", "output_core_partitions", "output_atts_partitions"]
    counts = spark.createDataFrame([tuple(int(m[k]) for k in keys)], ", ".join(f"{k} bigint" for k in keys))
    # what the files themselves say, and what is left in the landing folder
    written = result.written(spark).groupBy().agg(*(F.sum(F.when(F.col("output") == n, F.col("rows"))).alias(f"{n}_rows_in_files") for n in ("core", "atts")))
    left = spark.range(1).select(F.lit(list_files(spark, landing).count).cast("long").alias("left_in_landing"))
    return counts.join(written).join(left)


# Fixed value: landed records written twice into their file (corrupt uploads).
DOUBLED_RULE = "conv_id % 17 = 3"


def landing_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files (some holding two concatenated documents) through the real file scan."""
    apply_defaults(spark)
    root = scratch_path(spark, "quarantine")
    landing = write_landing_files(spark, sf_dir, f"{root}/landing", doubled=F.expr(DOUBLED_RULE))
    parsed = read_landing(spark, landing, shipped_contract().read_fields)
    doc = F.regexp_extract("source_path", r"(conv_[0-9]+)\.json$", 1)
    return parsed.select(doc.alias("doc"), "status", F.col("rec.trace_id").alias("trace_id"))


# Landed records whose file is empty, and whose turn count and end time can't be cast.
EMPTY_RULE = "conv_id % 7 = 3"
BAD_CAST_RULE = "conv_id % 6 = 2"
BAD_TIME_RULE = "conv_id % 10 = 4"


def landing_any_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible, hidden (``_x``, ``.x``, hidden folders) and empty files: all are read or reported."""
    apply_defaults(spark)
    root = scratch_path(spark, "anyname")
    landing = write_landing_files(spark, sf_dir, f"{root}/landing", empty=F.expr(EMPTY_RULE), hidden=True)
    parsed = read_landing(spark, landing, shipped_contract().read_fields)
    name = F.substring("source_path", F.lit(len(qualified(spark, landing)) + 2), F.length("source_path"))
    return parsed.select(name.alias("name"), "status", F.col("rec.trace_id").alias("trace_id"))


def incremental_any_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files through the incremental run: what its core output took and what it reports as skipped."""
    apply_defaults(spark)
    root = scratch_path(spark, "anystream")
    landing = write_landing_files(spark, sf_dir, f"{root}/landing", empty=F.expr(EMPTY_RULE), hidden=True)
    cfg = BatchConfig(contract=shipped_contract(), landing_path=landing, core_path=f"{root}/core",
                      atts_path=f"{root}/atts", endpoints=shipped_endpoints())
    results: list = []
    query = start_incremental(spark, cfg, f"{root}/_checkpoint", RUN_ID, now=NOW, results=results, keep_stages=True)
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    taken = read_hive_parquet(spark, cfg.core_path).select(F.col("base_nombre").alias("name"), F.lit("core").alias("went"))
    skipped = [r.skipped_files.select(F.regexp_extract("source_path", "[^/]*$", 0).alias("name"), F.col("reason").alias("went")) for r in results]
    for frame in skipped:
        taken = taken.unionByName(frame)
    return taken


def cast_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with turn counts and end times that can't be cast: every failing value with its reason; the others go on.

    Rows without a column name are the records that went on to the outputs.
    """
    apply_defaults(spark)
    contract = shipped_contract()
    recs = landing_records(spark, sf_dir).withColumns({
        "turns": F.when(F.expr(BAD_CAST_RULE), F.concat(F.lit("about "), F.col("turns"))).otherwise(F.col("turns").cast("string")),
        "exported_at": F.when(F.expr(BAD_TIME_RULE), F.lit("31/08/2026")).otherwise(F.col("exported_at"))})
    docs = recs.select("source_path", F.to_json(F.struct(*DOCUMENT_FIELDS)).alias("text"))
    mapped = stages.mapped(stages.good_docs(docs, contract), contract, stages.Options(on_cast_error="quarantine"))
    kept = stages.castable(mapped).select("source_path", F.lit(None).cast("string").alias("column"), F.col("interaccion_turnos").cast("string").alias("text"), F.lit(None).cast("string").alias("reason"))
    return stages.cast_errors(mapped).unionByName(kept)


def written_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition of a write, from the footers of the files it wrote."""
    apply_defaults(spark)
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    src = o.select("o_orderkey", "o_totalprice", "o_orderpriority",
                   F.when(k % 13 == 0, F.lit(None)).when(k % 17 == 0, F.lit("")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    result = write_hive_parquet(src, scratch_path(spark, "orders_files"), ["o_orderstatus", "o_orderpriority"], NOW, "orders")
    files = written_files(spark, result)
    value = lambda c: F.col("partition")[c].alias(c)
    return files.groupBy(value("o_orderstatus"), value("o_orderpriority"), value("year")).agg(
        F.sum("rows").alias("rows"), (F.min("bytes") > 0).alias("has_bytes"), F.lit(result.partitions).cast("long").alias("partitions"))


QUERIES = {
    "partition_roundtrip": partition_roundtrip,
    "declared_types": declared_types,
    "atts_roundtrip": atts_roundtrip,
    "incremental_ingest": incremental_ingest,
    "run_manifest": run_manifest,
    "landing_quarantine": landing_quarantine,
    "landing_any_name": landing_any_name,
    "incremental_any_name": incremental_any_name,
    "cast_quarantine": cast_quarantine,
    "written_manifest": written_manifest,
}
