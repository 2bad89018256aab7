"""Incremental ingest: each trigger takes only newly landed documents."""

import os

import pytest
from pyspark.errors import StreamingQueryException

from pactline.contract import shipped_contract, shipped_endpoints
from pactline.plans.pipeline import BatchConfig
from pactline.sinks.parquet import read_hive_parquet
from pactline.streaming.incremental import start_incremental
from tests.conftest import land
from tests.helpers import NOW


def test_two_runs_take_new_files_only(spark, records, workdir):
    cfg = BatchConfig(contract=shipped_contract(), landing_path=os.path.join(workdir, "landing"),
                      core_path=os.path.join(workdir, "core"), atts_path=os.path.join(workdir, "atts"),
                      endpoints=shipped_endpoints())
    ckpt = os.path.join(workdir, "_ckpt")
    land(workdir, "landing/a.json", records[0])
    land(workdir, "landing/bad.json", b"{oops")
    land(workdir, "landing/empty.json", b"")
    results = []
    q = start_incremental(spark, cfg, ckpt, "run", now=NOW, results=results)
    q.awaitTermination()
    assert read_hive_parquet(spark, cfg.core_path).count() == 1
    land(workdir, "landing/b.json", records[1])
    q = start_incremental(spark, cfg, ckpt, "run", now=NOW, results=results)
    q.awaitTermination()
    core = read_hive_parquet(spark, cfg.core_path)
    assert core.count() == 2
    assert sorted(r.ejecucion_id for r in core.collect()) == ["run-0", "run-1"]
    # The empty file is reported once, with the batch that listed it, and left in place.
    assert [(r.processed_files, r.skipped_count) for r in results] == [(1, 2), (1, 0)]
    assert os.path.exists(os.path.join(workdir, "landing", "empty.json"))


def test_finished_batch_is_not_processed_again(spark, records, workdir):
    cfg = BatchConfig(contract=shipped_contract(), landing_path=os.path.join(workdir, "landing"),
                      core_path=os.path.join(workdir, "core"), atts_path=os.path.join(workdir, "atts"),
                      endpoints=shipped_endpoints())
    ckpt = os.path.join(workdir, "_ckpt")
    land(workdir, "landing/a.json", records[0])
    q = start_incremental(spark, cfg, ckpt, "run", now=NOW)
    q.awaitTermination()
    assert os.path.exists(os.path.join(ckpt, "_pactline_done", "0.json"))
    # Simulate a restart that re-delivers batch 0: drop its offset commit.
    for name in ("0", ".0.crc"):
        if os.path.exists(os.path.join(ckpt, "commits", name)):
            os.remove(os.path.join(ckpt, "commits", name))
    results = []
    q = start_incremental(spark, cfg, ckpt, "run2", now=NOW, results=results)
    q.awaitTermination()
    assert os.path.exists(os.path.join(ckpt, "commits", "0"))  # batch 0 was delivered again...
    assert results == []  # ...and skipped
    assert read_hive_parquet(spark, cfg.core_path).count() == 1


def test_one_batch_dedups_everything_landed(spark, records, workdir):
    cfg = BatchConfig(contract=shipped_contract(), landing_path=os.path.join(workdir, "landing"),
                      core_path=os.path.join(workdir, "core"), atts_path=os.path.join(workdir, "atts"),
                      endpoints=shipped_endpoints())
    for i, rec in enumerate(records * 2):
        land(workdir, f"landing/r{i}.json", dict(rec, trace_id="same"))
    results = []
    start_incremental(spark, cfg, os.path.join(workdir, "_ckpt"), "run", now=NOW, results=results).awaitTermination()
    assert [r.processed_files for r in results] == [4]
    assert read_hive_parquet(spark, cfg.core_path).count() == 1


def test_incremental_consumes_good_files_only(spark, records, workdir):
    cfg = BatchConfig(contract=shipped_contract(), landing_path=os.path.join(workdir, "landing"),
                      core_path=os.path.join(workdir, "core"), atts_path=os.path.join(workdir, "atts"),
                      endpoints=shipped_endpoints(), delete_sources=True)
    ckpt = os.path.join(workdir, "_ckpt")
    land(workdir, "landing/a.json", records[0])
    land(workdir, "landing/bad.json", b"[1]")
    results = []
    start_incremental(spark, cfg, ckpt, "run", now=NOW, results=results).awaitTermination()
    assert sorted(os.listdir(os.path.join(workdir, "landing"))) == ["bad.json"]
    land(workdir, "landing/b.json", records[1])
    start_incremental(spark, cfg, ckpt, "run", now=NOW, results=results).awaitTermination()
    assert sorted(os.listdir(os.path.join(workdir, "landing"))) == ["bad.json"]
    assert [(r.processed_files, r.skipped_count, r.deleted_source_files) for r in results] == [(1, 1, 1), (1, 0, 1)]
    assert read_hive_parquet(spark, cfg.core_path).count() == 2


def test_batch_that_failed_before_its_marker_doubles_nothing(spark, records, workdir, monkeypatch):
    from pactline.streaming import incremental

    cfg = BatchConfig(contract=shipped_contract(), landing_path=os.path.join(workdir, "landing"),
                      core_path=os.path.join(workdir, "core"), atts_path=os.path.join(workdir, "atts"),
                      endpoints=shipped_endpoints(), requests_path=os.path.join(workdir, "requests"),
                      delete_sources=True)
    ckpt = os.path.join(workdir, "_ckpt")
    land(workdir, "landing/a.json", records[0])
    write = incremental.write_json_document

    def cut(session, path, payload):
        if path.endswith("/0.json"):
            raise OSError("lost before the marker")
        write(session, path, payload)

    monkeypatch.setattr(incremental, "write_json_document", cut)
    with pytest.raises(StreamingQueryException):
        start_incremental(spark, cfg, ckpt, "run", now=NOW).awaitTermination()
    atts = read_hive_parquet(spark, cfg.atts_path).count()
    requests = spark.read.json(cfg.requests_path).count()
    assert read_hive_parquet(spark, cfg.core_path).count() == 1 and atts and requests
    assert os.listdir(os.path.join(workdir, "landing")) == ["a.json"]  # not consumed before the marker
    monkeypatch.setattr(incremental, "write_json_document", write)
    results = []
    start_incremental(spark, cfg, ckpt, "again", results=results).awaitTermination()
    core = read_hive_parquet(spark, cfg.core_path)
    assert [r.ejecucion_id for r in core.collect()] == ["run-0"]
    assert read_hive_parquet(spark, cfg.atts_path).count() == atts
    assert spark.read.json(cfg.requests_path).count() == requests
    assert os.listdir(os.path.join(workdir, "landing")) == [] and results[0].deleted_source_files == 1
