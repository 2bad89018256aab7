"""Hive-partitioned Parquet output."""

import os
from pathlib import Path

import duckdb

from pactline.contract import shipped_contract
from pactline.plans import stages
from pactline.sinks.parquet import consume, delete_paths, read_hive_parquet, write_hive_parquet
from tests.helpers import CTX, NOW, mapped


def _files(root):
    return sorted(str(p.relative_to(root)) for p in Path(root).rglob("*.parquet"))


def _core(spark, records):
    contract = shipped_contract()
    return stages.outputs(stages.deduped(mapped(spark, records), contract), contract, CTX)[0]


def test_partitioned_layout_and_file_prefix(spark, records, workdir):
    out = os.path.join(workdir, "core")
    res = write_hive_parquet(_core(spark, records), out, shipped_contract().partitions, NOW, "transcripciones")
    files = _files(out)
    assert res.rows == 2 and res.partitions == 1 and files
    for f in files:
        assert f.startswith("cliente_prefijo=CLX/operacion_prefijo=SAC/year=2026/month=08/day=21/transcripciones_20260821T153045Z")


def test_partition_columns_live_in_the_path_only(spark, records, workdir):
    out = os.path.join(workdir, "core")
    write_hive_parquet(_core(spark, records), out, shipped_contract().partitions, NOW, "t")
    f = os.path.join(out, _files(out)[0])
    cols = [r[0] for r in duckdb.connect().execute(f"DESCRIBE SELECT * FROM read_parquet('{f}', hive_partitioning=false)").fetchall()]
    assert "cliente_prefijo" not in cols and "operacion_prefijo" not in cols
    types = dict((r[0], r[1]) for r in duckdb.connect().execute(f"DESCRIBE SELECT * FROM read_parquet('{f}', hive_partitioning=false)").fetchall())
    assert types["conversacion_id"] == "VARCHAR"
    assert types["interaccion_fecha_inicio"] == "TIMESTAMP"
    assert types["interaccion_turnos"] == "BIGINT"


def test_read_back_keeps_zero_padded_text(spark, records, workdir):
    out = os.path.join(workdir, "core")
    write_hive_parquet(_core(spark, records), out, shipped_contract().partitions, NOW, "t")
    back = read_hive_parquet(spark, out).select("cliente_prefijo", "year", "month", "day").distinct().collect()
    assert [tuple(r) for r in back] == [("CLX", "2026", "08", "21")]


def test_empty_frame_writes_no_data_file(spark, workdir):
    out = os.path.join(workdir, "empty")
    df = spark.createDataFrame([], "a string, b bigint")
    assert write_hive_parquet(df, out, ["a"], NOW, "p").rows == 0
    assert _files(out) == []


def test_unpartitioned_write_still_has_the_date(spark, workdir):
    out = os.path.join(workdir, "flat")
    df = spark.createDataFrame([("x", 1), ("y", 2)], "a string, b bigint")
    write_hive_parquet(df.coalesce(1), out, [], NOW, "part")
    files = _files(out)
    assert len(files) == 1 and files[0].startswith("year=2026/month=08/day=21/part_")
    assert read_hive_parquet(spark, out).count() == 2


def test_absent_partition_columns_are_ignored(spark, workdir):
    out = os.path.join(workdir, "p")
    df = spark.createDataFrame([("x", 1)], "a string, b bigint")
    res = write_hive_parquet(df, out, ["a", "not_there"], NOW, "p")
    assert res.partition_cols == ("a",)
    assert [tuple(r) for r in read_hive_parquet(spark, out).select("a", "b").collect()] == [("x", 1)]


def test_null_and_empty_partitions_read_back_as_null(spark, workdir):
    out = os.path.join(workdir, "nulls")
    df = spark.createDataFrame([("a", 1), (None, 2), ("", 3)], "k string, v bigint")
    write_hive_parquet(df, out, ["k"], NOW, "p")
    back = {r.v: r.k for r in read_hive_parquet(spark, out).collect()}
    assert back == {1: "a", 2: None, 3: None}


def test_consume_removes_exactly_the_given_files_and_names_failures(spark, workdir):
    keep = Path(workdir, "keep.json")
    keep.write_text("{}")
    gone = [Path(workdir, f"d{i}", "a b%20.json") for i in range(3)]
    for g in gone:
        g.parent.mkdir(parents=True)
        g.write_text("{}")
    folder = Path(workdir, "folder.json")
    folder.mkdir()
    paths = spark.createDataFrame([(f"file:{g}",) for g in [*gone, folder, Path(workdir, "missing.json")]], "source_path string")
    got = {Path(r.source_path).name if "d0" not in r.source_path else "first": (r.deleted, r.error is None) for r in consume(spark, paths).collect()}
    assert got == {"first": (True, True), "a b%20.json": (True, True), "folder.json": (False, False), "missing.json": (True, True)}
    assert keep.exists() and folder.exists() and not any(g.exists() for g in gone)
    assert delete_paths(spark, paths) == 4  # a second attempt finds them gone


def test_partition_values_with_separators_round_trip(spark, workdir):
    out = os.path.join(workdir, "esc")
    df = spark.createDataFrame([("a/b", 1), ("k=v", 2), ("ñ x", 3)], "k string, v bigint")
    write_hive_parquet(df, out, ["k"], NOW, "p")
    assert {r.v: r.k for r in read_hive_parquet(spark, out).collect()} == {1: "a/b", 2: "k=v", 3: "ñ x"}
    top = sorted(p.name for p in Path(out).iterdir() if p.is_dir())
    assert len(top) == 3  # one folder level per value: separators are escaped


def test_written_files_lists_one_writes_files(spark, records, workdir):
    from pactline.sinks.parquet import written_files

    out = os.path.join(workdir, "core")
    first = write_hive_parquet(_core(spark, records), out, shipped_contract().partitions, NOW, "t")
    later = NOW.replace(second=50)
    second = write_hive_parquet(_core(spark, records), out, shipped_contract().partitions, later, "t")
    a = {r.path for r in written_files(spark, first).collect()}
    b = {r.path for r in written_files(spark, second).collect()}
    assert a and b and not a & b
    assert all(p.rsplit("/", 1)[-1].startswith("t_20260821T153045Z") for p in a)
    assert len(a | b) == len(_files(out))
