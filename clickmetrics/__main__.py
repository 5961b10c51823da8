"""Jobs for spark-submit: ``python -m clickmetrics JOB ...``."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from datetime import date
from importlib import import_module

from pyspark.sql import SparkSession

from clickmetrics.config import AnalyticsConfig
from clickmetrics.plans import run_local_profile, run_metrics, run_warehouse_profile
from clickmetrics.plans.profiles import DAY_METRICS, HOUR_METRICS, USER_METRICS, Build
from clickmetrics.session import build_session
from clickmetrics.sinks import compact_events
from clickmetrics.streaming import (
    compact_quarantine,
    file_messages,
    ingest_messages,
    load_staged_csv,
)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="clickmetrics", description=__doc__)
    root.add_argument("--database", default="default")
    root.add_argument("--money-digits", type=int, help="decimals of reported money sums")
    jobs = root.add_subparsers(dest="job", required=True)

    load = jobs.add_parser("load-csv", help="load staged CSV files that were not loaded yet")
    ingest = jobs.add_parser("ingest", help="store the messages that landed in a folder")
    for job in (load, ingest):
        job.add_argument("path")
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--name", required=True, help="names the loads")
        job.add_argument("--archive", help="folder that files go to when they are done")
    ingest.add_argument("--once", action="store_true", help="stop when all messages are stored")

    compact = jobs.add_parser("compact", help="fold the loads and bad messages of closed days together")
    compact.add_argument("--before", type=date.fromisoformat, required=True)

    runs = {
        "local": jobs.add_parser("local", help="the local run"),
        "warehouse": jobs.add_parser("warehouse", help="the warehouse run"),
    }
    for run in runs.values():
        run.add_argument("--model-path", help="where the segment model is saved")
    metric = jobs.add_parser("metric", help="replace single metrics")
    metric.add_argument(
        "names",
        nargs="+",
        help=f"{', '.join([*USER_METRICS, *DAY_METRICS, *HOUR_METRICS])}, or name=module:function with a function "
        "of the rollup by user and the settings",
    )
    for job in (*runs.values(), metric):
        job.add_argument("--since", type=date.fromisoformat, help="first day")
        job.add_argument("--until", type=date.fromisoformat, help="day after the last")
    return root


def own_metrics(names: Sequence[str]) -> tuple[list[str], dict[str, Build]]:
    """Names, and the functions of those given as ``name=module:function``."""
    plain, own = [], {}
    for text in names:
        name, _, place = text.partition("=")
        plain.append(name)
        if place:
            module, _, function = place.partition(":")
            own[name] = getattr(import_module(module), function)
    return plain, own


def run(spark: SparkSession, arguments: Sequence[str]) -> list[str]:
    """Run a job; the names of the tables replaced, where it replaces tables."""
    given = parser().parse_args(arguments)
    config = AnalyticsConfig(database=given.database, money_digits=given.money_digits)
    if given.job == "load-csv":
        after = "keep" if given.archive is None else "archive"
        load_staged_csv(
            spark, given.path, given.checkpoint, given.name, config, after, given.archive
        )
        return []
    if given.job == "ingest":
        messages = file_messages(spark, given.path, archive=given.archive)
        ingest_messages(messages, given.name, given.checkpoint, config, given.once).awaitTermination()
        return []
    if given.job == "compact":
        compact_events(spark, given.before, config)
        compact_quarantine(spark, given.before, config)
        return []
    if given.job == "metric":
        names, own = own_metrics(given.names)
        return run_metrics(spark, names, config, since=given.since, until=given.until, more=own)
    profile = run_local_profile if given.job == "local" else run_warehouse_profile
    return profile(spark, config, given.model_path, given.since, given.until)


def main() -> None:
    parser().parse_args()  # a wrong call fails before a session starts
    for name in run(build_session(), sys.argv[1:]):
        print(name)


if __name__ == "__main__":
    main()
