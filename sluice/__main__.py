"""Command line: run one spec, or every spec of a folder."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from sluice.plans.job import run_all, run_job
from sluice.spec import load_spec


def main(argv: list[str] | None = None) -> int:
    """0 if every load succeeded, else 1."""
    parser = argparse.ArgumentParser(prog="sluice", description="Run ingestion jobs.")
    what = parser.add_mutually_exclusive_group(required=True)
    what.add_argument("--config", help="one job spec")
    what.add_argument("--config-dir", help="a folder of job specs")
    parser.add_argument("--audit", required=True, help="path of the audit log")
    parser.add_argument("--resume", action="store_true", help="start at the last run's bound")
    parser.add_argument("--parallel", type=int, default=1, help="jobs of a folder at a time")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")

    try:
        spec = load_spec(args.config) if args.config else None
    except (OSError, ValueError) as err:
        logging.error("%s: %s", args.config, err)
        return 1
    spark = SparkSession.builder.appName(spec.job_name if spec else "sluice").getOrCreate()
    try:
        if spec:
            return 0 if run_job(spark, spec, args.audit, resume=args.resume).ok else 1
        report = run_all(
            spark, args.config_dir, args.audit, resume=args.resume, parallel=args.parallel
        )
        return 0 if report.filter("status <> 'SUCCESS'").isEmpty() else 1
    except Exception:
        logging.exception("job failed")
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
