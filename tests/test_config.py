"""Configuration read from storage; run manifest written to storage."""

import json
import os
from pathlib import Path

import pytest

from pactline.contract import PACKAGE_CONTRACTS, shipped_contract, shipped_endpoints
from pactline.plans.pipeline import BatchConfig, run_batch
from pactline.sources.config import read_contract, read_endpoints, read_json_document
from tests.conftest import land
from tests.helpers import CTX


def test_contract_and_endpoints_from_storage(spark, workdir):
    res = Path(workdir, "resources")
    (res / "contracts").mkdir(parents=True)
    (res / "params/api").mkdir(parents=True)
    (res / "contracts/c.json").write_bytes((PACKAGE_CONTRACTS / "transcripts.json").read_bytes())
    (res / "params/api/index.json").write_text(json.dumps({"daily": ["x"], "unitary": ["params/api/unitary.json"]}))
    (res / "params/api/unitary.json").write_bytes((PACKAGE_CONTRACTS / "unitary.json").read_bytes())
    contract = read_contract(spark, f"file:{res}/contracts/c.json")
    assert contract.raw == shipped_contract().raw
    assert read_endpoints(spark, f"file:{res}", "params/api/index.json") == shipped_endpoints()


def test_missing_config_raises(spark, workdir):
    with pytest.raises(Exception):
        read_json_document(spark, f"file:{workdir}/nope.json")


def test_manifest_and_sorted_requests(spark, records, workdir):
    land(workdir, "landing/a.json", records[0])
    land(workdir, "landing/b.json", records[1])
    cfg = BatchConfig(contract=shipped_contract(), landing_path=os.path.join(workdir, "landing"),
                      core_path=os.path.join(workdir, "core"), atts_path=os.path.join(workdir, "atts"),
                      endpoints=shipped_endpoints(), requests_path=os.path.join(workdir, "req"),
                      manifest_path=os.path.join(workdir, "runs"))
    run_batch(spark, cfg, CTX)
    manifest = json.loads(Path(workdir, "runs", f"run_{CTX.run_id}.json").read_text())
    assert manifest["processed_files"] == 2 and manifest["core_rows"] == 2 and manifest["atts_rows"] == 36
    assert manifest["output_core_partitions"] == 1 and manifest["output_atts_partitions"] == 1
    lines = [json.loads(line) for f in sorted(Path(workdir, "req").glob("part-*.json")) for line in f.read_text().splitlines()]
    assert [r["conversation_id"] for r in lines] == sorted(r["conversation_id"] for r in lines)


def test_json_document_round_trip(spark, workdir):
    from pactline.sources.config import write_json_document

    target = f"file:{workdir}/some/key.json"
    write_json_document(spark, target, {"a": 1, "b": "x", "ñ": [True, None]})
    assert read_json_document(spark, target) == {"a": 1, "b": "x", "ñ": [True, None]}
    assert "ñ" in Path(workdir, "some/key.json").read_text(encoding="utf-8")  # not ASCII-escaped
