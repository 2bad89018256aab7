import json
import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

@pytest.fixture(scope="session")
def spark():
    from pactline.session import build_session

    # A generated-code compile failure fails the test instead of silently
    # falling back to interpreted execution.
    session = build_session("local[4]", app="pactline-tests", shuffle_partitions=8,
                            extra={"spark.sql.codegen.fallback": "false"})
    yield session
    session.stop()


@pytest.fixture
def workdir():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="pactline-test-", dir=os.environ.get("PACTLINE_TEST_TMP", "/tmp"))


@pytest.fixture
def records():
    """Two sample documents."""
    from tests.helpers import landed_record

    return [landed_record(1), landed_record(2)]


def land(folder: str, name: str, payload) -> str:
    """Write one landing file; ``payload`` is a dict (JSON) or raw bytes."""
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    data = payload if isinstance(payload, bytes) else json.dumps(payload, ensure_ascii=False).encode("utf-8")
    path.write_bytes(data)
    return str(path)
