"""Run one load from the command line.

    python -m batchgate <job.json|job.yaml|entity> <yyyy-MM-dd> <batch_id> [source_name]
        [--landing PATH] [--tables ROOT] [--control TABLE] [--audit TABLE]

A bare entity name (``customers``) builds the standard config, which then
needs ``--landing`` (and ``--tables`` for path tables).
"""

from __future__ import annotations

import argparse
import json
import sys


def _load(spec: str, landing: str | None, tables: str | None) -> dict:
    if spec.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:  # pragma: no cover
            raise SystemExit("YAML configs need PyYAML; pass a .json config instead") from e
        with open(spec) as fh:
            return yaml.safe_load(fh)
    if spec.endswith(".json"):
        with open(spec) as fh:
            return json.load(fh)
    from .jobs import entity_job
    if not landing:
        raise SystemExit("--landing is required with an entity name")
    return entity_job(spec, landing, table_root=tables)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="batchgate")
    p.add_argument("job")
    p.add_argument("business_date")
    p.add_argument("batch_id", type=int)
    p.add_argument("source_name", nargs="?")
    p.add_argument("--landing")
    p.add_argument("--tables")
    p.add_argument("--control")
    p.add_argument("--audit")
    args = p.parse_args(argv)

    from pyspark.sql import SparkSession

    from .plans.job import run_job
    config = _load(args.job, args.landing, args.tables)
    details = {"business_date": args.business_date, "batch_id": args.batch_id}
    if args.source_name:
        details["source_name"] = args.source_name
    spark = SparkSession.builder.getOrCreate()
    out = run_job(spark, config, details, control=args.control, audit=args.audit)
    print(json.dumps({k: v for k, v in out.items() if k != "results"}, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
