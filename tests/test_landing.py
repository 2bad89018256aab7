"""Landing folders listed and read by tasks: hidden, empty, nested and oversized files, batch and stream."""

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pactline.contract import load_contract, shipped_contract, shipped_endpoints
from pactline.operators.mapping import map_records
from pactline.plans import stages
from pactline.plans.pipeline import BatchConfig, run_batch
from pactline.sinks.parquet import read_hive_parquet, write_hive_parquet, written_files
from pactline.sources.documents import parse_documents
from pactline.sources.landing import land as land_documents
from pactline.sources.landing import read_landing
from pactline.sources.listing import list_files, read_files
from pactline.streaming.incremental import start_incremental
from tests.conftest import land
from tests.helpers import CTX, NOW

ANY_NAME = {"a.json": b'{"trace_id":"a"}', "_x.json": b'{"trace_id":"x"}', ".y.json": b'{"trace_id":"y"}', "_d/z.json": b'{"trace_id":"z"}',
            ".e/f/W.JSON": b'{"trace_id":"w"}', "k=v/q.json": b'{"trace_id":"q"}', "sp ace%20+\u00fc.json": b'{"trace_id":"s"}',
            "empty.json": b"", "_empty.json": b"", "broken.json": b"{", "note.txt": b"{}", "json": b"{}"}
EXPECTED = {n: "empty" if not c else "invalid_json" if c == b"{" else "ok" for n, c in ANY_NAME.items() if n.lower().endswith(".json")}


def _cfg(workdir, **kw):
    return BatchConfig(contract=shipped_contract(), landing_path=os.path.join(workdir, "landing"), core_path=os.path.join(workdir, "core"),
                       atts_path=os.path.join(workdir, "atts"), endpoints=shipped_endpoints(), **kw)


def _relative(root, path):
    return os.path.relpath(path.removeprefix("file:"), root)


def test_every_name_is_read_or_reported(spark, workdir):
    for name, content in ANY_NAME.items():
        land(workdir, f"landing/{name}", content)
    root = os.path.join(workdir, "landing")
    got = {_relative(root, r.source_path): (r.status, r.rec and r.rec.trace_id) for r in read_landing(spark, root, ["trace_id"]).collect()}
    assert {n: s for n, (s, _) in got.items()} == EXPECTED
    assert got["_d/z.json"] == ("ok", "z") and got[".e/f/W.JSON"] == ("ok", "w")
    plan = read_landing(spark, root, ["trace_id"])._jdf.queryExecution().toString()
    assert "a.json" not in plan and "z.json" not in plan


def test_folders_beyond_a_tasks_budget_go_to_the_next_round(spark, workdir):
    for i in range(40):
        land(workdir, f"landing/{i % 7}/{i % 3}/{i}.json", b"{}")
    tables = []
    listed = list_files(spark, os.path.join(workdir, "landing"), budget=5, stages=tables)
    assert listed.count == 40 and len(tables) > 1 and listed.files.select("path").distinct().count() == 40
    assert listed.bytes == 80
    assert list_files(spark, os.path.join(workdir, "nowhere")).count == 0


def test_oversized_files_are_reported_unread(spark, workdir):
    land(workdir, "landing/small.json", b'{"a":"1"}')
    land(workdir, "landing/large.json", b'{"a":"' + b"1" * 200 + b'"}')
    parsed, landed = land_documents(spark, os.path.join(workdir, "landing"), ["a"], max_bytes=100)
    assert landed == 2
    assert {Path(r.source_path).name: r.status for r in parsed.collect()} == {"small.json": "ok", "large.json": "too_large"}


def test_a_file_that_goes_away_fails_a_batch(spark, workdir):
    land(workdir, "landing/a.json", b"{}")
    listed = list_files(spark, os.path.join(workdir, "landing"))
    os.rename(os.path.join(workdir, "landing/a.json"), os.path.join(workdir, "b.json"))
    with pytest.raises(Exception, match="a.json"):
        read_files(listed, 1 << 30).collect()


def test_incremental_takes_and_reports_any_name(spark, records, workdir):
    cfg, ckpt = _cfg(workdir, delete_sources=True), os.path.join(workdir, "_ckpt")
    land(workdir, "landing/_hidden.json", records[0])
    land(workdir, "landing/.dir/.empty.json", b"")
    results = []

    def run():
        start_incremental(spark, cfg, ckpt, "run", now=NOW, results=results, keep_stages=True).awaitTermination()

    run()
    assert [(r.processed_files, r.skipped_count, r.deleted_source_files) for r in results] == [(1, 1, 1)]
    assert [(Path(r.source_path).name, r.reason) for r in results[0].skipped_files.collect()] == [(".empty.json", "empty")]
    run()  # nothing new: the empty file was taken before
    assert len(results) == 1
    land(workdir, "landing/.dir/.empty.json", records[1])  # the upload is repeated, whole this time
    run()
    assert [(r.processed_files, r.skipped_count) for r in results[1:]] == [(1, 0)]
    assert sorted(r.base_nombre for r in read_hive_parquet(spark, cfg.core_path).collect()) == [".empty.json", "_hidden.json"]
    assert not [p for p in Path(workdir, "landing").rglob("*") if p.is_file()]


def test_cast_errors_are_set_aside_with_their_reasons(spark, records, workdir):
    land(workdir, "landing/a.json", records[0])
    land(workdir, "landing/b.json", dict(records[1], turns="seven", exported_at="yesterday"))
    res = run_batch(spark, _cfg(workdir, delete_sources=True, options=stages.Options(on_cast_error="quarantine")), CTX)
    assert (res.processed_files, res.cast_error_records, res.skipped_count, res.deleted_source_files) == (1, 1, 0, 1)
    errors = sorted((Path(r.source_path).name, r.column, r.text, r.reason) for r in res.cast_errors.collect())
    assert errors == [("b.json", "interaccion_fecha_fin", "yesterday", "not_timestamp"), ("b.json", "interaccion_turnos", "seven", "not_integer")]
    assert read_hive_parquet(spark, os.path.join(workdir, "core")).count() == 1
    assert [p.name for p in Path(workdir, "landing").iterdir()] == ["b.json"]
    assert {r.output for r in res.written(spark).collect()} == {"core", "atts"}
    assert res.written(spark).where("output = 'atts'").agg(F.sum("rows")).first()[0] == 18


JSON_CONTRACT = {
    "source": {"bucket_name": "x", "prefix_pattern": "x"},
    "columns": [{"position": 1, "name": "v", "source_column": "v", "type": "json"},
                {"position": 2, "name": "same", "source_column": "v", "type": "string"},
                {"position": 3, "name": "const", "type": "json", "default_value": {"b": [1, "\u00e9"], "a": None}},
                {"position": 4, "name": "word", "type": "json", "default_value": " x "}],
    "transformations": [{"type": "trim", "selector": "all-string"}, {"type": "uppercase", "columns": ["v"]}],
    "output_core": {"bucket_name": "o", "prefix_pattern": "c", "output_name_file": "c", "technical_col_keep": []},
    "output_atts": {"bucket_name": "o", "prefix_pattern": "a", "output_name_file": "a",
                    "technical_col_keep": ["atributo_nombre", "atributo_tipo", "atributo_posicion", "atributo_valor"]},
}


@pytest.mark.parametrize("mode", ["compact", "python"])
def test_json_values_keep_their_kind(spark, mode):
    values = ["hello", " pad ", "5", 5, 1.5, True, None, "true", "null", {"z": 1, "a": "x"}, '{"q": 1}', [1, "2", None], "[1]", 'qu"ote\\\n', "\u00e9"]
    contract = load_contract(JSON_CONTRACT)
    docs = spark.createDataFrame([(str(i), json.dumps({"v": v})) for i, v in enumerate(values)], "source_path string, text string")
    parsed = parse_documents(docs, contract.read_fields, json_fields=contract.json_fields)
    mapped = map_records(parsed, contract, json_mode=mode)
    core, atts = stages.outputs(mapped, contract, CTX)
    dump = lambda v: json.dumps(v, ensure_ascii=False, separators=(",", ":") if mode == "compact" else None)
    got = {int(r.source_path): r for r in mapped.collect()}
    for i, v in enumerate(values):
        cleaned = v.strip().upper() if isinstance(v, str) else v
        assert got[i].v == (None if v is None else dump(cleaned)), v
    constant, word = dump({"b": [1, "\u00e9"], "a": None}), '"x"'
    assert {(r.const, r.word) for r in core.collect()} == {(constant, word)}
    assert {r.atributo_valor for r in atts.where("atributo_nombre = 'const'").collect()} == {constant}
    assert {r.atributo_valor for r in atts.where("atributo_nombre = 'word'").collect()} == {word}
    in_core, in_atts = ({r[0] for r in frame.collect()} for frame in (core.select("v"), atts.where("atributo_nombre = 'v'").select("atributo_valor")))
    assert in_core == in_atts


def test_written_files_say_rows_bytes_and_partitions(spark, workdir):
    df = spark.createDataFrame([("a/b", 1), ("k=v", 2), (None, 3), ("", 4), ("\u00f1 +%", 5), ("\u00f1 +%", 6)], "k string, v bigint")
    result = write_hive_parquet(df, os.path.join(workdir, "out"), ["k"], NOW, "p")
    rows = written_files(spark, result).collect()
    by_key = {}
    for r in rows:
        by_key[r.partition["k"]] = by_key.get(r.partition["k"], 0) + r.rows
        assert r.bytes > 0 and r.partition["year"] == "2026" and set(r.partition) == {"k", "year", "month", "day"}
    assert by_key == {"a/b": 1, "k=v": 1, None: 2, "\u00f1 +%": 2}
    assert result.partitions == 4
