"""Batch runs that die on the way and are run again."""

import json
import os
from pathlib import Path

import pytest

from pactline.contract import shipped_contract, shipped_endpoints
from pactline.plans import journal, pipeline
from pactline.plans.pipeline import BatchConfig, run_batch
from pactline.sinks.parquet import read_hive_parquet
from tests.conftest import land


class Died(Exception):
    pass


def _cfg(workdir):
    return BatchConfig(contract=shipped_contract(), landing_path=os.path.join(workdir, "landing"), core_path=os.path.join(workdir, "core"),
                       atts_path=os.path.join(workdir, "atts"), requests_path=os.path.join(workdir, "requests"), endpoints=shipped_endpoints(),
                       delete_sources=True, journal_path=os.path.join(workdir, "journal"))


def _state(spark, workdir):
    core = read_hive_parquet(spark, os.path.join(workdir, "core"))
    rows = sorted((r.base_nombre, r.ejecucion_id) for r in core.collect())
    atts = read_hive_parquet(spark, os.path.join(workdir, "atts")).count()
    requests = spark.read.json(os.path.join(workdir, "requests")).count()
    return rows, atts, requests, sorted(p.name for p in Path(workdir, "landing").iterdir())


def _phase(workdir):
    return json.loads(Path(workdir, "journal", "run.json").read_text())["phase"]


def test_a_run_that_dies_while_it_writes_is_done_again_in_its_own_place(spark, records, workdir, monkeypatch):
    land(workdir, "landing/a.json", records[0])
    monkeypatch.setattr(journal.Journal, "written", lambda self, sources: (_ for _ in ()).throw(Died()))
    with pytest.raises(Died):
        run_batch(spark, _cfg(workdir))  # outputs are there, but nobody noted that they are complete
    monkeypatch.undo()
    assert _phase(workdir) == "started"
    (_, first), = _state(spark, workdir)[0]
    land(workdir, "landing/b.json", records[1])  # landed in between: taken, too
    run_batch(spark, _cfg(workdir))
    assert _state(spark, workdir) == ([("a.json", first), ("b.json", first)], 36, 2, [])
    assert _phase(workdir) == "finished"


def test_a_run_that_dies_while_it_deletes_only_deletes_the_rest(spark, records, workdir, monkeypatch):
    land(workdir, "landing/a.json", records[0])
    land(workdir, "landing/b.json", records[1])

    def dies(spark, paths, column="source_path"):
        os.rename(os.path.join(workdir, "landing/a.json"), os.path.join(workdir, "gone"))
        raise Died()

    monkeypatch.setattr(pipeline, "consume", dies)
    with pytest.raises(Died):
        run_batch(spark, _cfg(workdir))
    monkeypatch.undo()
    assert _phase(workdir) == "written"
    before = _state(spark, workdir)
    assert before[1:] == (36, 2, ["b.json"])
    result = run_batch(spark, _cfg(workdir))  # nothing new has landed
    assert result.processed_files == 0
    assert _state(spark, workdir) == (before[0], 36, 2, [])
    land(workdir, "landing/c.json", dict(records[0], trace_id="other"))
    run_batch(spark, _cfg(workdir))
    rows = _state(spark, workdir)[0]
    assert [n for n, _ in rows] == ["a.json", "b.json", "c.json"] and len({run for _, run in rows}) == 2
