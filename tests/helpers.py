import json
from datetime import datetime, timezone

from pactline.contract import shipped_contract
from pactline.operators.audit import RunContext
from pactline.plans import stages

NOW = datetime(2026, 8, 21, 15, 30, 45, tzinfo=timezone.utc)
CTX = RunContext(run_id="exec-1", now=NOW)


def landed_record(n):
    """The n-th sample document, built from its number: ids, times and texts all differ."""
    turns = [{"role": ("assistant", "user")[k % 2], "content": f"Mensaje {n}.{k}: ¿señal {k * n}?"} for k in range(n + 2)]
    return {
        "tenant_id": f"tenant_{n}", "client_dni": str(10_000_000 + 7919 * n), "client_dni_type": ("CC", "ce")[n % 2],
        "cloud_conversation_id": f"{n:08d}-aaaa-4bbb-8ccc-{n:012d}", "trace_id": f"{n:032x}", "interaction_result": "" if n % 2 else "resuelto",
        "started_at": f"2026-03-{n:02d}T08:{n:02d}:05+02:00", "exported_at": f"2026-03-{n:02d}T10:45:{n:02d}+02:00",
        "turns": len(turns), "messages": turns, "person_type": "Natural", "client_name": f"  Íñigo{n} ", "client_last_name": "Ångström",
    }


def documents(spark, records, paths=None):
    """Records (dicts) -> ``(source_path, text)`` documents in listing order."""
    paths = paths or [f"landing/f{i:03d}.json" for i in range(len(records))]
    rows = [(p, json.dumps(r, ensure_ascii=False)) for p, r in zip(paths, records)]
    return spark.createDataFrame(rows, "source_path string, text string")


def mapped(spark, records, contract=None, paths=None, opts=stages.Options()):
    contract = contract or shipped_contract()
    return stages.mapped(stages.good_docs(documents(spark, records, paths), contract), contract, opts)


def by(rows, key, value):
    return next(r for r in rows if r[key] == value)
