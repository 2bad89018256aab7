"""Every opN query and the pipeline where workers cannot import this package, on awkward and on empty tables."""

import json
import os
import random
import subprocess
import sys
from pathlib import Path

import pytest

from tests.llm.helpers import awkward_docs, empty_docs

ROOT = str(Path(__file__).resolve().parents[2])
PROBE = """
import json, sys
root, tables, checkpoints = sys.argv[1:]
sys.path.insert(0, root)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.checkpoint.dir", checkpoints).getOrCreate())
spark.sparkContext.setLogLevel("OFF")

def importable(_):
    try:
        import pactline
        return "importable"
    except ImportError:
        return "absent"

assert spark.sparkContext.parallelize([0], 1).map(importable).collect() == ["absent"]
import __spark_entry__
out = {}
for name, query in __spark_entry__.queries().items():
    if name.startswith("op") or name == "pipeline":
        out[name] = query(spark, tables).count()
print("RESULT" + json.dumps(out))
"""


def write_tables(spark, folder, empty):
    docs, rows = awkward_docs(spark)
    docs = empty_docs(spark) if empty else docs
    # names that operators use for their own columns
    clash = "_doc long, _tid long, drops string, _row string, _rank int, size int, bits string, shingle long"
    docs = docs.crossJoin(spark.createDataFrame([(1, 2, "x", "y", 3, 4, "b", 5)], clash))
    rng = random.Random(1)
    ids = sorted({d for d, _ in rows if d is not None})
    labels = [] if empty else [(i, rng.randrange(2), int(i % 5 == 0), "c") for i in ids] + [(None, 1, 1, "c"), (ids[0], None, None, "c")]
    bench = [] if empty else [("a", rows[3][1], 1), ("b", "", 1), (None, "w1 w2 w3", 1), ("c", None, 1)]
    pages = [] if empty else [(i, f"http://h{i % 2}/{i}", f"<body><div>same</div><p>text {i} of the page</p></body>", "c") for i in range(6)] + [(None, None, None, "c")]
    talks = [] if empty else [(i // 3, i % 3, ["user", "assistant", None][i % 3], f"Turn {i}.", "c") for i in range(30)] + [(None, None, None, None, "c")]
    for name, frame in {
        "documents": docs, "labels": spark.createDataFrame(labels, "doc_id long, quality long, toxic long, text string"),
        "benchmark": spark.createDataFrame(bench, "item_id string, text string, word int"),
        "pages": spark.createDataFrame(pages, "page_id long, url string, html string, host string"),
        "conversations": spark.createDataFrame(talks, "conv_id long, turn long, role string, text string, later string"),
    }.items():
        frame.coalesce(2).write.parquet(f"{folder}/{name}.parquet")
    return 0 if empty else len(rows)


@pytest.mark.parametrize("empty", [False, True])
def test_every_query_without_the_package(spark, workdir, empty):
    n = write_tables(spark, workdir, empty)
    probe = Path(workdir, "probe.py")
    probe.write_text(PROBE)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(probe), ROOT, workdir, f"{workdir}/checkpoints"], cwd=workdir, env=env, capture_output=True, text=True, timeout=1500)
    assert done.returncode == 0, done.stderr[-3000:]
    counts = json.loads(done.stdout.split("RESULT")[1])
    assert len(counts) == 14
    per_document = [q for q in counts if q.split("_")[0] in ("op1", "op2", "op4", "op5", "op7", "op8", "op9", "op10", "op11", "op13")]
    assert len(per_document) == 10 and {counts[q] for q in per_document} == {n}
    if empty:
        assert set(counts.values()) == {0}
