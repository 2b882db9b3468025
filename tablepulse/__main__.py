"""Run one job, for ``spark-submit`` or ``python -m tablepulse``.

    backfill-reviews --root ROOT --site SITE
    ingest-reviews   --root ROOT --site SITE
    ingest-health    --root ROOT
    publish          --root ROOT [--prefix PREFIX]
    upkeep           --root ROOT [--keep RELEASES], between batches
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession

from tablepulse.layout import Site, health_site
from tablepulse.plans.upkeep import upkeep
from tablepulse.session import apply_runtime_settings
from tablepulse.sources.catalog import publish_warehouse
from tablepulse.streaming.bookmark import (
    backfill_landed_reviews,
    ingest_new_health,
    ingest_new_reviews,
)


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tablepulse", description="Restaurant quality jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("backfill-reviews", "ingest-reviews", "ingest-health", "publish", "upkeep"):
        job = jobs.add_parser(name)
        job.add_argument("--root", required=True, help="folder of the warehouse")
        if name == "publish":
            job.add_argument("--prefix", default="", help="put before every table name")
            continue
        if name == "upkeep":
            job.add_argument("--keep", type=int, default=2, help="releases to keep")
            continue
        job.add_argument("--earliest", type=date.fromisoformat, default=None)
        job.add_argument("--latest", type=date.fromisoformat, default=None)
        if name.endswith("reviews"):
            job.add_argument("--site", required=True, help="for example yelp_reviews")
        if name.startswith("ingest"):
            job.add_argument("--max-files", type=int, default=None, help="files per batch")
    return parser.parse_args(argv)


def _plausible(args: argparse.Namespace) -> tuple[date, date] | None:
    if args.earliest is None and args.latest is None:
        return None
    return args.earliest or date.min, args.latest or date.max


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"tablepulse {args.job}").getOrCreate()
    apply_runtime_settings(spark)
    if args.job == "publish":
        publish_warehouse(spark, args.root, args.prefix)
    elif args.job == "upkeep":
        upkeep(spark, args.root, args.keep)
    elif args.job == "backfill-reviews":
        backfill_landed_reviews(spark, Site(args.root, args.site), plausible=_plausible(args))
    elif args.job == "ingest-reviews":
        ingest_new_reviews(
            spark,
            Site(args.root, args.site),
            max_files_per_trigger=args.max_files,
            plausible=_plausible(args),
        )
    else:
        ingest_new_health(
            spark,
            health_site(args.root),
            max_files_per_trigger=args.max_files,
            plausible=_plausible(args),
        )


if __name__ == "__main__":
    main()
