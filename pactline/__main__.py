"""Run a contract as a Spark job.

    spark-submit -m pactline --contract s3a://resources/contracts/t.json \\
        --root s3a:// --env-prefix env-dev- --api-index params/api/core.json [--incremental ...]

Locations come from the contract: ``source`` for the landing folder,
``output_core``/``output_atts`` for the outputs, each logical name mapped
through ``--env-prefix``/``--root`` (``contract.Locations``).
"""

from __future__ import annotations

import argparse
import json
import sys

from pactline.contract import Locations
from pactline.plans.pipeline import BatchConfig, run_batch
from pactline.plans.stages import Options
from pactline.session import build_session
from pactline.sources.config import read_contract, read_endpoints


def build_config(spark, args) -> BatchConfig:
    contract = read_contract(spark, args.contract)
    loc = Locations(prefix=args.env_prefix, root=args.root)

    def endpoints() -> dict:
        # Loaded only once a run has documents (an empty landing folder reads no configuration).
        return read_endpoints(spark, loc.resolve(args.resources), args.api_index) if args.api_index else {}

    return BatchConfig(
        contract=contract,
        landing_path=loc.path(*contract.landing),
        core_path=loc.path(contract.core.location, contract.core.prefix),
        atts_path=loc.path(contract.atts.location, contract.atts.prefix),
        endpoints=endpoints,
        requests_path=args.requests,
        manifest_path=args.manifests,
        delete_sources=args.delete_sources,
        options=Options(on_cast_error="null" if args.lenient_casts else args.on_cast_error, accents=args.accents, json_text=args.json_text),
    )


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="pactline", description="Run an ingestion contract on Spark.")
    p.add_argument("--contract", required=True, help="contract JSON (any Hadoop file system URI)")
    p.add_argument("--root", default=None, help="storage root the logical locations live under")
    p.add_argument("--env-prefix", default="", help="prefix added to logical location names")
    p.add_argument("--resources", default="resources", help="logical location of the API index")
    p.add_argument("--api-index", default=None, help="API index key below the resources location")
    p.add_argument("--requests", default=None, help="where request rows are written (JSON lines)")
    p.add_argument("--manifests", default=None, help="where run manifests are written")
    p.add_argument("--delete-sources", action="store_true", help="consume read documents after both writes")
    p.add_argument("--lenient-casts", action="store_true", help="bad integers/timestamps become null")
    p.add_argument("--on-cast-error", choices=("fail", "null", "quarantine"), default="fail",
                   help="bad integers/timestamps fail the run, become null, or set their record aside")
    p.add_argument("--accents", choices=("native", "exact"), default="native")
    p.add_argument("--json-text", choices=("compact", "python"), default="compact",
                   help="json columns as compact JSON, or spaced as json.dumps writes them")
    p.add_argument("--incremental", default=None, metavar="CHECKPOINT",
                   help="run as Structured Streaming (availableNow) with this checkpoint location")
    p.add_argument("--run-id", default=None, help="run id (incremental runs append the batch id)")
    p.add_argument("--explain", action="store_true",
                   help="print the physical plans of the run (staged, core, atts) without running it")
    return p.parse_args(argv)


def explain(spark, cfg: BatchConfig) -> dict:
    """The plans a run would execute, as text (nothing is read or written)."""
    from pactline.operators.audit import RunContext
    from pactline.plans import stages
    from pactline.sources.documents import parse_binary_documents
    from pactline.sources.landing import scan_files

    parsed = parse_binary_documents(scan_files(spark, cfg.landing_path), cfg.contract.read_fields,
                                    json_fields=cfg.contract.json_fields)
    staged = stages.mapped(parsed, cfg.contract, cfg.options, keep=("source_path", "status"))
    mapped = stages.good(staged).drop("status")
    if cfg.options.on_cast_error == "quarantine":
        mapped = stages.castable(mapped)
    core, atts = stages.outputs(stages.deduped(mapped, cfg.contract), cfg.contract, RunContext.fresh())

    def plan(df) -> str:
        return df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))

    return {"staged": plan(staged), "core": plan(core), "atts": plan(atts)}


def main(argv: list[str] | None = None, spark=None) -> dict:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    spark = spark or build_session()
    cfg = build_config(spark, args)
    if args.explain:
        plans = explain(spark, cfg)
        for name, text in plans.items():
            print(f"== {name} ==\n{text}")
        return plans
    if args.incremental:
        import uuid

        from pactline.streaming.incremental import start_incremental

        results: list = []
        query = start_incremental(spark, cfg, args.incremental, args.run_id or str(uuid.uuid4()), results=results)
        query.awaitTermination()
        summary = {"batches": [r.manifest() for r in results]}
    else:
        result = run_batch(spark, cfg)
        summary = result.manifest()
        result.drop_stages(spark)
    print(json.dumps(summary, default=str))
    return summary


if __name__ == "__main__":
    main()
